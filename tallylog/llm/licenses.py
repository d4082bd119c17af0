"""Licence scans by canonical digests: texts are brought to one spelling and looked up whole.

The whole text of a document, each paragraph of one that has several, and each line of a paragraph
that has several are units. A unit matches if its canonical form equals that of a known
licence text; digests are compared by a hash join. Units whose canonical length no known text
has are left out before they are hashed, which loses none; a list of known texts of more than ``SIZES`` lengths is compared
by digests alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Lengths of known texts that units are compared with before they are hashed.
SIZES = 1000

# Spellings that licence matching treats as equal, canonical one last.
SPELLINGS = (
    ("licence", "license"), ("licenced", "licensed"), ("sub license", "sublicense"), ("non commercial", "noncommercial"),
    ("organisation", "organization"), ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("artefact", "artifact"),
    ("authorisation", "authorization"), ("authorised", "authorized"), ("behaviour", "behavior"), ("centre", "center"),
    ("cancelled", "canceled"), ("favour", "favor"), ("fulfil ", "fulfill "), ("initialise", "initialize"), ("judgement", "judgment"),
    ("labelling", "labeling"), ("recognise", "recognize"), ("utilisation", "utilization"), ("per cent", "percent"),
    ("copyright holder ", "copyright owner "), ("https", "http"), ("merchantibility", "merchantability"), ("whilst", "while"),
)

# Public licence texts and the notices that stand for them.
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of
the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT
SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF
CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN
THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE
IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
SOFTWARE."""
_APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS
IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License."""
_BSD_2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this
list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. """
_BSD_3 = _BSD_2 + """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
promote products derived from this software without specific prior written permission. """
_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL,
EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF
USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT
LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED
OF THE POSSIBILITY OF SUCH DAMAGE."""
_0BSD = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted. """ + _ISC[_ISC.index("THE SOFTWARE") :]
_UNLICENSE = """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish,
use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose,
commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this
software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit
of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of
relinquishment in perpetuity of all present and future rights to this software under copyright law. THE SOFTWARE IS PROVIDED
"AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE
USE OR OTHER DEALINGS IN THE SOFTWARE."""
# Its last line is often there, and often not.
_MORE = " For more information, please refer to <https://unlicense.org>"
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any
purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following
restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original
software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is
not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original
software. 3. This notice may not be removed or altered from any source distribution."""
_WHOLE = tuple(
    (name, title + reserved + body)
    for name, titles, body in (
        ("BSD-2-Clause", ("", "BSD 2-Clause License ", "The BSD 2-Clause License "), _BSD_2 + _BSD_END),
        ("BSD-3-Clause", ("", "BSD 3-Clause License ", "The BSD 3-Clause License "), _BSD_3 + _BSD_END),
    )
    for title in titles
    for reserved in ("", "All rights reserved. ")
) + (
    ("0BSD", _0BSD), ("0BSD", "BSD Zero Clause License " + _0BSD), ("0BSD", "Zero-Clause BSD " + _0BSD), ("Unlicense", _UNLICENSE),
    ("Unlicense", _UNLICENSE + _MORE), ("Zlib", _ZLIB), ("Zlib", "zlib License " + _ZLIB),
)
KNOWN = (
    ("MIT", _MIT), ("MIT", "MIT License " + _MIT), ("MIT", "The MIT License (MIT) " + _MIT), ("MIT", "Released under the MIT License"),
    ("MIT", "Licensed under the MIT License"), ("MIT", "This project is licensed under the MIT License"), ("MIT", "SPDX-License-Identifier: MIT"),
    ("ISC", _ISC), ("ISC", "ISC License " + _ISC), ("ISC", "Licensed under the ISC License"), ("ISC", "SPDX-License-Identifier: ISC"),
    ("Apache-2.0", _APACHE), ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "Released under the Apache License, Version 2.0"), ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3"), ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2"), ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License"), ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License"), ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("MPL-2.0", "Licensed under the Mozilla Public License, version 2.0"), ("MPL-2.0", "SPDX-License-Identifier: MPL-2.0"),
    ("CC0-1.0", "Licensed under CC0 1.0"), ("CC-BY-4.0", "Licensed under CC BY 4.0"), ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"), ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0"),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0"), ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0"),
    ("proprietary", "All rights reserved"), *_WHOLE,
)

# Words after "copyright" that go on a sentence of a licence, rather than name who holds the rights.
SENTENCE = "notice notices holder holders owner owners license licence law laws interest statement statements and or as in".split()
# A line of rights: a sign, or the word with anything but such a word after it.
_COPYRIGHT = (
    r"(?m)^[^\\p{L}\\p{N}\\n]*(?:\\(c\\)|©|copyright(?![^\\p{L}\\p{N}\\n]*(?:" + "|".join(SENTENCE) + r")(?![\\p{L}\\p{N}])))[^\\n]*$"
)


def canonical(text: str) -> str:
    """SQL of the canonical form; line ends stay.

    Lower case, lines of rights that begin with a copyright mark emptied, every run of other characters than
    letters and digits one space, spellings of one word unified.
    """
    out = f"lower({text})"
    out = f"CASE WHEN contains({out}, 'copyright') OR contains({out}, '(c)') OR contains({out}, '©') " \
        f"THEN regexp_replace({out}, '{_COPYRIGHT}', '') ELSE {out} END"
    out = f"regexp_replace({out}, '[^\\\\p{{L}}\\\\p{{N}}\\\\n]+', ' ')"
    for old, new in SPELLINGS:
        if " " not in old:
            out = f"replace({out}, '{old}', '{new}')"
    return out


def joined(line: str) -> str:
    """SQL of a canonical text without line ends, spellings of several words unified."""
    for old, new in SPELLINGS:
        if " " in old:
            line = f"replace({line}, '{old}', '{new}')"
    return line


def flat(text: str) -> str:
    """SQL of a canonical text on one line, wherever its lines ended."""
    return joined(f"trim(regexp_replace({text}, '[ \\\\n]+', ' '))")


def known_licenses(spark: SparkSession, texts=KNOWN) -> DataFrame:
    """``license, digest, size`` of licence texts; the list is fixed, a hundred texts or so."""
    frame = spark.createDataFrame(list(texts), "license string, text string")
    frame = frame.selectExpr("license", f"{canonical('text')} AS c").selectExpr("license", f"{flat('c')} AS c")
    return frame.selectExpr("license", "sha2(c, 256) AS digest", "length(c) AS size").distinct()


def scan(docs: DataFrame, known: DataFrame | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row ``doc_id, license, unit, paragraph, line`` for every unit that is a known licence text.

    ``unit`` is ``text``, ``paragraph`` or ``line``; numbers count from 0 and are null where they don't
    apply. Null and empty texts match nothing, repeated rows match once each, an empty table gives no
    rows, other columns play no part. A text listed under two licences matches both.
    """
    known = known_licenses(docs.sparkSession) if known is None else known
    # Units of other lengths than the known texts' need no digest. Where the list has many lengths, all units get one.
    sizes = [row["size"] for row in known.select("size").distinct().limit(SIZES + 1).collect()]
    fits = f"array_contains(array({', '.join(map(str, sizes)) or '-1'}), length({{}}))"
    if len(sizes) > SIZES:
        fits = "length({}) >= 0"
    each = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("t")).filter("t IS NOT NULL")
    each = each.selectExpr("doc_id", f"{canonical('t')} AS c")
    each = each.selectExpr("doc_id", f"{flat('c')} AS whole", "split(c, '\\\\n[ \\\\n]*\\\\n', -1) AS paragraphs")
    unit = "named_struct('unit', '{}', 'paragraph', {}, 'line', {}, 'c', {})"
    no = "CAST(NULL AS INT)"
    as_text = f"filter(array({unit.format('text', no, no, 'whole')}), u -> {fits.format('u.c')})"
    as_paragraph = (
        f"CASE WHEN size(paragraphs) > 1 THEN filter(transform(paragraphs, (p, i) -> "
        f"{unit.format('paragraph', 'i', no, flat('p'))}), u -> {fits.format('u.c')}) ELSE array() END"
    )
    in_lines = f"transform(split(p, '\\\\n', -1), (x, j) -> {unit.format('line', 'i', 'j', joined('trim(x)'))})"
    as_line = (
        f"flatten(transform(paragraphs, (p, i) -> CASE WHEN contains(p, '\\n') THEN "
        f"filter({in_lines}, u -> {fits.format('u.c')}) ELSE array() END))"
    )
    units = each.selectExpr("doc_id", f"explode(concat({as_text}, {as_paragraph}, {as_line})) AS u")
    units = units.selectExpr("doc_id", "u.unit", "u.paragraph", "u.line", "sha2(u.c, 256) AS digest")
    return units.join(known.select("license", "digest"), "digest").select("doc_id", "license", "unit", "paragraph", "line")
