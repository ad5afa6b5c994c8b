"""Line-first cleaning: rules judge each line, failing lines go, documents that lose too much go whole.

The rules of a line with words (lines without a word are never judged and carry no text):

- punctuation: over half as many symbols as words, three or more doubled exclamation marks in ten
  words, or twelve words and more without any sentence mark;
- stutter: three or more words in ten that repeat the word before;
- navigation: three or more separators, and two or more in ten words;
- boilerplate: a licence, rights, cookie or script notice, or a line equal to an earlier one.

A document is kept if its base rules hold and the failing lines have at most half of its word
characters. Null and blank texts have no words: all numbers are 0 and the base rule rejects them.
Null ids, ties and repeated rows are rows like others, each judged by itself; an empty table gives an
empty result. Each row needs memory for its own text only.
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame

from tripmill.llm.common import per_text

#: Fixed values of the contract.
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
LEAST_WORDS = 10
#: Parameters of the line rules; shares are counts in ten words.
EXCLAIMED, STUTTERED, SEPARATED = 3, 3, 2
LEAST_SEPARATORS = 3
MARKED_FROM = 12
SEPARATORS = "|»›•·"
MARKS = ".!?…;:"
BOILERPLATE = (
    r"licen[sc]ed under|all rights reserved|released under the|general public license|copyright \(c\)|"
    r"terms of (use|service)|privacy policy|accept (all )?cookies|uses cookies|enable javascript|"
    r"subscribe to our|sign up for|click here|lorem ipsum|skip to content"
)

_NOTICE = re.compile(BOILERPLATE, re.IGNORECASE | re.ASCII)
_MARK = re.compile(f"[{MARKS}]")
_GAPS = str.maketrans("", "", " \t\n\x0b\x0c\r")


def repeated_words(words: list) -> int:
    """Words inside windows of five words that occur twice or more, their first occurrence included."""
    windows = list(zip(*[words[k:] for k in range(WINDOW)], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    counts, total, covered = Counter(windows), 0, 0
    for i, w in enumerate(windows):
        if counts[w] > 1:
            total += i + WINDOW - max(i, covered)
            covered = i + WINDOW
    return total


def line_fault(line: str) -> str | None:
    """The rule that a line with words fails, or None."""
    words = line.encode().split()
    n = len(words)
    if 2 * sum(map(line.count, SYMBOLS)) > n or 10 * line.count("!!") >= EXCLAIMED * n or n >= MARKED_FROM and not _MARK.search(line):
        return "punctuation"
    if 10 * sum(a == b for a, b in zip(words, words[1:], strict=False)) >= STUTTERED * n:
        return "stutter"
    separators = sum(map(line.count, SEPARATORS))
    if separators >= LEAST_SEPARATORS and 10 * separators >= SEPARATED * n:
        return "navigation"
    if _NOTICE.search(line):
        return "boilerplate"
    return None


def clean(text: str | None) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, lost_chars, base_failed, kept, cleaned text."""
    text = text or ""
    words = text.encode().split()
    n = len(words)
    word_chars = len(text.translate(_GAPS))
    seen, good, lost, copies = set(), [], 0, 0
    for line in text.split("\n"):
        chars = len(line.translate(_GAPS))
        if not chars:
            continue
        again = line in seen
        seen.add(line)
        copies += again
        if again or line_fault(line):
            lost += chars
        else:
            good.append(line)
    repeated = repeated_words(words)
    failed = n < LEAST_WORDS or 100 * repeated > 20 * n
    kept = not failed and 2 * lost <= word_chars
    return n, word_chars, sum(map(text.count, SYMBOLS)), copies, repeated, lost, failed, kept, "\n".join(good)


FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lost_chars", "base_failed", "kept", "cleaned")
SCHEMA = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "lost_chars bigint, base_failed boolean, kept boolean"
)


def judge(docs: DataFrame, texts: bool = False) -> DataFrame:
    """One row per document; with ``texts`` also what is left of it. The rows never move."""

    names = FIELDS if texts else FIELDS[:-1]
    schema = SCHEMA + (", cleaned string" if texts else "")
    rows = docs.selectExpr("cast(doc_id as bigint) AS doc_id", "text")
    return rows.mapInArrow(per_text(lambda text: clean(text)[: len(names)], ["doc_id"], names), schema)


ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, unnest(l) AS word, generate_subscripts(l, 1) AS p FROM (SELECT r, regexp_extract_all(text, '{WORD}') AS l FROM d)),
w5 AS (SELECT r, p, CASE WHEN lead(word, 4) OVER s IS NOT NULL THEN
    [word, lead(word, 1) OVER s, lead(word, 2) OVER s, lead(word, 3) OVER s, lead(word, 4) OVER s] END AS five
  FROM w WINDOW s AS (PARTITION BY r ORDER BY p)),
c5 AS (SELECT r, p, five IS NOT NULL AND count(*) OVER (PARTITION BY r, five) > 1 AS twice FROM w5),
cover AS (SELECT r, max(twice::INT) OVER (PARTITION BY r ORDER BY p ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS inside FROM c5),
repeats AS (SELECT r, sum(inside)::BIGINT AS n_repeat_words FROM cover GROUP BY r),
l AS (SELECT r, unnest(s) AS line, generate_subscripts(s, 1) AS p FROM (SELECT r, string_split(text, chr(10)) AS s FROM d)),
l2 AS (SELECT r, line, regexp_extract_all(line, '{WORD}') AS ws, row_number() OVER (PARTITION BY r, line ORDER BY p) > 1 AS again FROM l),
l3 AS (SELECT r, again, len(ws) AS n, list_sum(list_transform(ws, lambda x: length(x))) AS chars, again
    OR 2 * len(regexp_extract_all(line, '[#*$%&|<>]')) > len(ws)
    OR 10 * len(regexp_extract_all(line, '!!')) >= {EXCLAIMED} * len(ws)
    OR (len(ws) >= {MARKED_FROM} AND NOT regexp_matches(line, '[{MARKS}]'))
    OR 10 * len(list_filter(range(2, len(ws) + 1), lambda i: ws[i] = ws[i - 1])) >= {STUTTERED} * len(ws)
    OR (len(regexp_extract_all(line, '[{SEPARATORS}]')) >= {LEAST_SEPARATORS}
      AND 10 * len(regexp_extract_all(line, '[{SEPARATORS}]')) >= {SEPARATED} * len(ws))
    OR regexp_matches(line, '(?i)({BOILERPLATE})') AS fails
  FROM l2 WHERE len(ws) > 0),
lines AS (SELECT r, sum(again::INT)::BIGINT AS n_dup_lines, sum(chars)::BIGINT AS word_chars, coalesce(sum(chars) FILTER (fails), 0)::BIGINT AS lost_chars,
    sum(n)::BIGINT AS n_words FROM l3 GROUP BY r),
f AS (SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(lost_chars, 0) AS lost_chars
  FROM d LEFT JOIN lines USING (r) LEFT JOIN repeats USING (r))
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND 2 * lost_chars <= word_chars AS kept
FROM f
"""
