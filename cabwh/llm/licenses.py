"""License notices: exact phrases, and fuzzy search for short notices.

A text is reduced to its words joined by single blanks. A notice of which at most ``k`` characters may differ
is split into ``k + 1`` parts: by the pigeonhole principle one of them stands unchanged in every match, so an
Aho-Corasick automaton over the parts finds all places worth looking at. Around each, the ``regex`` library's
bounded-error matching verifies the notice and reports the span and the number of edits. One pass, no shuffle.

Defined cases: a null or empty text has no words, no labels and score 0; very long texts are scanned whole;
repeated rows each get their own result; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabwh.llm.common import plain, table, texts_of

# Phrases that name a license wherever their words stand consecutively.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Short notices as words (part that may be misspelt, words that must follow exactly, label).
NOTICES = [
    ("released under the mit license", "", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy", "", "mit"),
    ("licensed under the apache license version", "2", "apache-2"),
    ("licensed under the gnu general public license version", "2", "gpl-2"),
    ("licensed under the gnu general public license version", "3", "gpl-3"),
    ("gnu lesser general public license version", "2 1", "lgpl-2.1"),
    ("gnu lesser general public license version", "3", "lgpl-3"),
    ("gnu affero general public license version", "3", "agpl-3"),
    ("subject to the terms of the mozilla public license", "", "mpl-2"),
    ("licensed under the creative commons attribution", "4 0", "cc-by"),
    ("licensed under the creative commons attribution sharealike", "", "cc-by-sa"),
    ("licensed under the creative commons attribution noncommercial", "", "cc-by-nc"),
    ("redistribution and use in source and binary forms with or without modification", "", "bsd"),
    ("permission to use copy modify and or distribute this software for any purpose", "", "isc"),
    ("this is free and unencumbered software released into the public domain", "", "unlicense"),
]
#: One edit is allowed for so many characters of a notice.
CHARS_PER_EDIT = 12

_WORD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
              for b in range(256))
SCHEMA = pa.schema([
    ("id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
    ("last_word", pa.int64()), ("base_labels", pa.list_(pa.string())), ("labels", pa.list_(pa.string())),
    ("score", pa.float64()),
    ("spans", pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64()),
                                  ("edits", pa.int32())]))),
])
DDL = ("id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels array<string>, "
       "labels array<string>, score double, "
       "spans array<struct<label:string,first_word:bigint,n_words:bigint,edits:int>>")


def edits_allowed(notice: str) -> int:
    return len(notice) // CHARS_PER_EDIT


def seeds(notice: str) -> list[tuple[int, str]]:
    """(offset, part): the notice in ``k + 1`` parts, of which k edits must leave one unchanged."""
    parts = edits_allowed(notice) + 1
    cuts = [len(notice) * i // parts for i in range(parts + 1)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


@lru_cache(maxsize=1)
def _search() -> tuple[ahocorasick.Automaton, list]:
    found: dict[str, list] = {}
    for i, (notice, _, _) in enumerate(NOTICES):
        for offset, part in seeds(notice):
            found.setdefault(part, []).append((i, offset, len(part)))
    machine = ahocorasick.Automaton()
    for part, places in found.items():
        machine.add_word(part, places)
    machine.make_automaton()
    patterns = [regex.compile(r"(?<= )(?b:(?:%s){e<=%d})%s(?= )" % (notice, edits_allowed(notice), tail and f" {tail}"))
                for notice, tail, _ in NOTICES]
    return machine, patterns


def fuzzy_spans(body: str) -> list[tuple[str, int, int, int]]:
    """(label, start, end, edits) of every notice in ``body`` (words between single blanks, one at either end)."""
    machine, patterns = _search()
    windows: dict[int, list[list[int]]] = {}
    for end, places in machine.iter(body):
        for i, offset, size in places:
            notice, tail, _ = NOTICES[i]
            k, start = edits_allowed(notice), end + 1 - size - offset
            lo, hi = max(0, start - k - 1), start + len(notice) + len(tail) + k + 2
            own = windows.setdefault(i, [])
            if own and lo <= own[-1][1]:
                own[-1][1] = max(own[-1][1], hi)
            else:
                own.append([lo, hi])
    spans = []
    for i, own in windows.items():
        for lo, hi in own:
            for m in patterns[i].finditer(body[lo:hi]):
                spans.append((NOTICES[i][2], lo + m.start(), lo + m.end(), sum(m.fuzzy_counts)))
    return sorted(set(spans))


def _blanks(text: bytes, unit: type = np.uint8) -> np.ndarray:
    return np.flatnonzero(np.frombuffer(text, dtype=unit) == 32)


def scan_text(text: bytes) -> dict:
    """Word count, places of the base phrases, fuzzy spans and labels of one whole text."""
    words = text.translate(_WORD).split()
    padded = b" " + b" ".join(words) + b" "
    starts, base = [], set()
    for phrase, label in BASE_PHRASES.items():
        needle = f" {phrase} ".encode()
        at = padded.find(needle)
        while at >= 0:
            starts.append(at)
            base.add(label)
            at = padded.find(needle, at + 1)
    # a place's word is the number of blanks before it; they are looked for once, however many places there are
    starts = np.searchsorted(_blanks(padded), starts).tolist() if starts else []
    body = padded.decode("utf-8", "replace")
    found = fuzzy_spans(body)
    if found:
        blanks = _blanks(body.encode("utf-32-le"), np.uint32)
        first, after = (np.searchsorted(blanks, [f[side] for f in found]).tolist() for side in (1, 2))
    else:
        first = after = []
    spans = [{"label": label, "first_word": n - 1, "n_words": m - n + 1, "edits": edits, "share": 1 - edits / (b - a)}
             for (label, a, b, edits), n, m in zip(found, first, after, strict=True)]
    return {"n_words": len(words), "n_base": len(starts), "first_word": min(starts, default=None),
            "last_word": max(starts, default=None), "base_labels": sorted(base),
            "labels": sorted(base | {s["label"] for s in spans}),
            "score": max([1.0 if base else 0.0, *(s.pop("share") for s in spans)]), "spans": spans}


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: word count, base places, labels, score and the fuzzy spans (in words)."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), texts_of(batch.column(1))
            yield pa.RecordBatch.from_pylist([{"id": i} | scan_text(t) for i, t in zip(ids, texts, strict=True)],
                                             SCHEMA)

    return plain(docs, id=id_col, text=text_col).mapInArrow(scan, DDL)


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License labels of every document."""
    return scan_licenses(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_words", "n_base", "first_word", "last_word",
        F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score")
