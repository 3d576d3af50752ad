"""Small tables with every odd case: nulls, empty and long texts, ties, repeats, clashing column names."""

import hashlib
import re
import zlib

SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
#: Extra columns whose names operators use themselves.
CLASHING = ", score DOUBLE, copies BIGINT, matches STRING, fp BIGINT, component_id BIGINT, batch BIGINT, training BOOLEAN"
FILLER = "the quick brown fox jumps over a lazy dog while seven wizards mix potions in a quiet valley near the old river"


def text(seed: int, words: int) -> str:
    """Words that depend on the seed alone."""
    out = []
    for i in range(words):
        h = hashlib.md5(f"{seed}:{i}".encode()).hexdigest()
        out.append(FILLER.split()[int(h[:2], 16) % 21] if int(h[2], 16) < 8 else "w" + h[3 : 5 + int(h[5], 16) % 4])
    return " ".join(out)


def documents(spark, rows=None, extra=False):
    rows = odd_rows() if rows is None else rows
    if not extra:
        return spark.createDataFrame(rows, SCHEMA)
    more = [(*r, 9.0, 9, "x", 9, 9, 9, None) for r in rows]
    return spark.createDataFrame(more, SCHEMA + CLASHING)


def odd_rows():
    passage = text(99, 30)
    return [
        (1, text(1, 60), "en", "a", 0),
        (2, text(1, 60), "en", "a", 0),  # a copy
        (3, text(1, 60) + " end", "en", None, 0),  # nearly a copy
        (4, None, None, None, None),
        (5, "", "en", "b", 0),
        (6, " \n\t ", "en", "b", 0),
        (7, text(7, 20) + " " + passage + " " + text(8, 20), "en", "c", 0),
        (8, passage + "\n" + text(9, 15), "de", "c", 0),
        (9, "one", "en", "c", 0),
        (10, "One  two", "en", "c", 0),
        (11, text(11, 4000), "en", "a", 0),  # very long
        (12, "ÀÉ ß 漢字 \x1c naïve\u00a0x", "fr", "b", 0),
        (13, text(13, 40), "en", "a", 0),
        (13, text(13, 40), "en", "a", 0),  # a repeated row
        (14, text(14, 40), "en", "b", 0),
        (14, text(15, 40), "en", "b", 0),  # an id that two texts share
        (None, text(16, 40), "en", "c", 0),
        (None, text(1, 60), "en", "c", 0),
    ]


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def fold(doc_id):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % 5
