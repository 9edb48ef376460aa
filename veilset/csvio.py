"""One CSV dialect for every sink and source, so that what is written is read
back as it was: line breaks, quotes, blanks at either end, empty strings and
NULLs included.

A field is quoted when it needs to be, a quote inside is doubled, NULL is
nothing between separators and the empty string is ``""``.  A record may span
lines, so a file is read by one task; sinks close a file after
``RECORDS_PER_FILE`` records to keep that bounded.
"""

from __future__ import annotations

DIALECT = {"escape": '"', "nullValue": "", "lineSep": "\n",
           "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
WRITE = {**DIALECT, "emptyValue": '""'}
# On reading, what stands for NULL must differ from the empty string; no text
# is expected to be this one, of two private characters.
READ = {**DIALECT, "nullValue": "\ue000\uf8ff", "emptyValue": "", "multiLine": "true",
        # a header that does not name the columns in their order is an error
        "enforceSchema": "false", "mode": "FAILFAST"}
RECORDS_PER_FILE = 1_000_000
