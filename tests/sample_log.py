"""A six-line log whose report is known."""

GOLDEN_LINES = [
    '10.0.0.1 - - [01/Jan/2020:10:00:05 +0000] "GET /usr/login HTTP/1.0" 200 1200 "-" "UA/1.0" 100',
    '10.0.0.2 - - [01/Jan/2020:15:30:59 +0530] "post /usr/register HTTP/1.0" 500 1000 "-" "UA/1.0" 320',
    '10.0.0.1 - - [01/Jan/2020:10:01:00 +0000] "POST /usr/register HTTP/1.0" 502 1000 "-" "UA/1.0" 300',
    '10.0.0.2 - - [01/Jan/2020:10:02:30 +0000] "GET /usr/admin HTTP/1.0" 404 - "-" "UA/1.0" 150',
    "not a log line",
    '10.0.0.3 - - [01/Jan/2020:11:00:00 +0000] "DELETE /usr/admin/developer HTTP/1.0" 200 1500 "-" "UA/1.0" 250',
]
