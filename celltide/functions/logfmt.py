"""Parse bridge log lines ``level=… ts=… caller=… msg="…"``.

``msg`` is the last field and may hold anything, also what looks like another
field; the others are looked for only before it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns of the logfmt fields; ``msg`` is a Go-quoted string up to the end of the line.
LEVEL_RE = r"(?:^|\s)level=(\S+)"
TS_RE = r"(?:^|\s)ts=(\S+)"
CALLER_RE = r"(?:^|\s)caller=(\S+)"
MSG_RE = r'(?s)(?:^|\s)msg=".*"\s*\z'
# One escape of a Go-quoted string, or a stretch without any.
PIECE_RE = r"(?s)\\(?:x[0-9a-fA-F]{2}|u[0-9a-fA-F]{4}|U[0-9a-fA-F]{8}|.)|[^\\]+"

# What the one-letter escapes stand for; any other letter stands for itself.
LETTERS = {"n": "\n", "t": "\t", "r": "\r", "a": "\a", "b": "\b", "f": "\f", "v": "\v"}


def _unescape(piece: Column) -> Column:
    letter, code = F.substring(piece, 2, 1), F.unhex(F.substring(piece, 3, 8))
    out = F.when(~F.startswith(piece, F.lit("\\")), piece)
    out = out.when((letter == "x") & (F.length(piece) == 4), F.decode(code, "ISO-8859-1"))
    out = out.when((letter == "u") & (F.length(piece) == 6), F.decode(code, "UTF-16BE"))
    out = out.when((letter == "U") & (F.length(piece) == 10), F.decode(code, "UTF-32"))
    for k, v in LETTERS.items():
        out = out.when(letter == k, F.lit(v))
    return out.otherwise(letter)


def unquote_go(c: Column) -> Column:
    """Undo the escapes of a Go-quoted string in one pass, from left to right."""
    pieces = F.regexp_extract_all(c, F.lit(PIECE_RE), F.lit(0))
    return F.when(F.contains(c, F.lit("\\")), F.array_join(F.transform(pieces, _unescape), "")).otherwise(c)


def parse(line: Column) -> Column:
    """Struct ``level, ts (timestamp, ns cut to µs), caller, msg``; NULL parts when absent."""
    msg = F.regexp_substr(line, F.lit(MSG_RE))
    head = F.when(msg.isNull(), line).otherwise(F.left(line, F.length(line) - F.length(msg)))

    def grab(rx: str) -> Column:
        return F.nullif(F.regexp_extract(head, rx, 1), F.lit(""))

    inner = F.regexp_replace(F.regexp_replace(msg, r'\A\s?msg="', ""), r'"\s*\z', "")
    return F.struct(
        grab(LEVEL_RE).alias("level"),
        grab(TS_RE).try_cast("timestamp").alias("ts"),
        grab(CALLER_RE).alias("caller"),
        unquote_go(inner).alias("msg"),
    )
