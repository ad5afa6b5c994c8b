"""Token counts of sections by offsets: whole documents are encoded once, tokens are joined to sections.

A document is encoded as a whole, so its token ids are those that training will see. The bytes of the
tokens follow on each other, which gives every token its span of characters; the sections of the text are
spans, too. Tokens and sections are joined by interval. A token that crosses a boundary counts whole for
one section, by RULE:

- ``first``: the section that holds its first byte;
- ``most``: the section that holds most of its bytes, the earlier one of equals.

Counts of a document's sections therefore add up to its tokens. Sections are the lines of a text, each
with its line end, unless another cutter is given; a cutter's sections follow on each other.

Defined results: null and empty texts have one section with no characters and no tokens. Null ids and
repeated rows are documents like others; an empty table gives an empty result. Whole texts are encoded, one at a time,
runs of a million blanks included. Ties by ``most`` go to the earlier section. Extra columns of any name are not read.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tripmill.llm.packing import added_tokens, vocabulary, whole_encoder

RULES = ("first", "most")


def lines(text: str) -> np.ndarray:
    """Where sections end, in characters: after each line end, and at the end of the text."""
    ends = np.flatnonzero(np.fromiter((c == "\n" for c in text), dtype=bool, count=len(text))) + 1 if "\n" in text else np.empty(0, np.int64)
    return ends if len(ends) and ends[-1] == len(text) else np.append(ends, len(text))


def attribute(token_bytes: np.ndarray, data: bytes, ends: np.ndarray, rule: str = "first") -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each section, and how many of those cross its end.

    ``token_bytes``: length of each token in bytes; ``data``: the text in UTF-8; ``ends``: section ends in characters.
    """
    if not len(data):
        return np.zeros(len(ends), np.int64), np.zeros(len(ends), np.int64)
    raw = np.frombuffer(data, np.uint8)
    # The byte at which each character begins, and the end of the text.
    begins = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))
    cuts = begins[ends]
    stop = np.cumsum(token_bytes)
    start = stop - token_bytes
    first = np.searchsorted(cuts, start, side="right")
    last = np.searchsorted(cuts, stop - 1, side="right")
    home = first
    if rule == "most":
        home = first.copy()
        for i in np.flatnonzero(first != last):
            inside = np.arange(first[i], last[i] + 1)
            low = np.concatenate(([0], cuts))[inside]
            held = np.minimum(cuts[inside], stop[i]) - np.maximum(low, start[i])
            home[i] = inside[held.argmax()]
    elif rule != "first":
        raise ValueError(f"rule must be one of {RULES}")
    crossing = np.bincount(home[first != last], minlength=len(ends))
    return np.bincount(home, minlength=len(ends)), crossing


def count(docs: DataFrame, tokenizer: str, pattern: str, rule: str = "first", cutter: Callable[[str], np.ndarray] = lines) -> DataFrame:
    """One row per section: doc_id, section (from 0), start and n_chars in characters, n_tokens, n_crossing."""
    names = ["doc_id", "section", "start", "n_chars", "n_tokens", "n_crossing"]

    def batches(parts):
        encode = whole_encoder(tokenizer, pattern)
        words = vocabulary(tokenizer) | {t.encode(): i for t, i in added_tokens(tokenizer).items()}
        sizes = np.zeros(max(words.values()) + 1, dtype=np.int64)
        for word, i in words.items():
            sizes[i] = len(word)
        for part in parts:
            for at in range(0, part.num_rows, 500):
                rows = part.slice(at, 500)
                owner, found = [], []
                for i, text in enumerate(rows.column("text")):
                    text = text.as_py() or ""
                    ends = cutter(text)
                    tokens, crossing = attribute(sizes[encode(text)], text.encode(), ends, rule)
                    starts = np.concatenate(([0], ends[:-1]))
                    owner.append(np.full(len(ends), i))
                    found.append(np.stack([np.arange(len(ends)), starts, ends - starts, tokens, crossing]))
                table = np.concatenate(found, axis=1)
                ids = rows.column("doc_id").take(pa.array(np.concatenate(owner)))
                yield pa.RecordBatch.from_arrays([ids, pa.array(table[0].astype(np.int32)), *map(pa.array, table[1:])], names=names)

    schema = "doc_id bigint, section int, start bigint, n_chars bigint, n_tokens bigint, n_crossing bigint"
    return docs.selectExpr("cast(doc_id as bigint) AS doc_id", "text").mapInArrow(batches, schema)
