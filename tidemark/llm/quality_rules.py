"""Quality rules by weak supervision.

Each rule votes *good* (1), *bad* (0) or abstains (-1) on a document. How far a rule can be trusted is not given: expectation-
maximisation over the vote patterns of all documents estimates its accuracy and how often it votes in either class, and
the posterior probability of *good* takes the place of a filter in which every rule must pass. The patterns of R rules
are at most 3^R rows whatever the number of documents; they are counted in Spark, and only the counts reach the driver.
"""

from __future__ import annotations

import re
from collections import Counter
from operator import eq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import columns, free_name, map_texts, quoted, written

MIN_WORDS, REPEAT_WINDOW, REPEAT_PERCENT = 20, 8, 30
#: Characters that count as symbols; the white space that parts words.
SYMBOLS, SPACE = b"#*$%&|<>", b" \t\n\r\x0b\x0c"
BASE = [("n_words", "bigint"), ("word_chars", "bigint"), ("n_symbols", "bigint"), ("n_dup_lines", "bigint"), ("n_repeat_words", "bigint")]
#: rule: the measure at which it votes bad, and the one at which it votes good; in between it abstains. A rule that only
#: knows a fault votes bad or abstains (None): a missing fault is no proof of quality. Fixed values.
RULES = {
    "plain_words": (0.60, 0.85),    # share of words that are letters with at most one mark behind
    "letters": (0.75, 0.90),        # share of letters among the characters of words
    "symbols": (0.20, None),        # symbols to a word
    "shouting": (0.40, None),       # upper-case share of ASCII letters
    "exclamation": (0.15, None),    # exclamation marks to a word
    "dup_lines": (0.50, None),      # share of lines that equal an earlier one
    "repetition": (0.30, None),     # share of words in a window found twice
    "long_words": (14.0, None),     # mean characters of a word
    "few_kinds": (0.90, None),      # share of words that equal an earlier one of the same thousand
    "stutter": (0.20, None),        # share of words that equal the one before
}
#: Of a class (bad, good): how often a rule votes bad, good, or abstains, before any document is seen.
START = {True: [[0.45, 0.30, 0.25], [0.02, 0.90, 0.08]], False: [[0.30, 0.01, 0.69], [0.003, 0.01, 0.987]]}
PRIOR_GOOD = 0.8
PSEUDO = 0.2
THRESHOLD = 0.5
_UPPERS = bytes(range(65, 91))
_ASCII_LETTERS = bytes(range(65, 91)) + bytes(range(97, 123))
_PLAIN = re.compile(rb"(?<![^\x20\x09-\x0d])[A-Za-z\x80-\xff]+[.,;:?!]?(?![^\x20\x09-\x0d])")


def repeated_words(words: list[bytes], window: int = REPEAT_WINDOW) -> int:
    """Words inside windows that occur twice or more in the text, the first occurrence included."""
    if len(words) <= window:
        return 0
    hashes = list(map(hash, zip(*[words[i:] for i in range(window)])))
    if len(set(hashes)) == len(hashes):
        return 0  # equal windows have equal hashes
    seen = Counter(hashes)
    again = [(i, tuple(words[i:i + window])) for i, h in enumerate(hashes) if seen[h] > 1]
    times = Counter(g for _, g in again)
    count, until = 0, 0
    for i, g in again:
        if times[g] > 1:
            count += i + window - max(i, until)
            until = i + window
    return count


def measures(text: str | None) -> tuple[list[int], list[float]]:
    """The base counts (as BASE) and the measure of each rule (as RULES). A null text has no words."""
    raw = (text or "").encode()
    words = raw.split()
    n = len(words)
    spaces = len(raw) - len(raw.translate(None, SPACE))
    word_chars = len(text or "") - spaces
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x.translate(None, SPACE)]
    dup_lines = len(lines) - len(set(lines))
    repeats = repeated_words(words)
    ascii_letters = len(raw) - len(raw.translate(None, _ASCII_LETTERS))
    upper = len(raw) - len(raw.translate(None, _UPPERS))
    letters = ascii_letters + (0 if len(raw) == len(text or "") else sum(map(str.isalpha, text)) - ascii_letters)
    pieces = [words[i:i + 1000] for i in range(0, n, 1000)]
    again = sum(len(p) - len(set(p)) for p in pieces)
    w = max(n, 1)
    rules = [len(_PLAIN.findall(raw)) / w, letters / max(word_chars, 1), symbols / w, upper / max(ascii_letters, 1), raw.count(b"!") / w,
             dup_lines / max(len(lines), 1), repeats / w, word_chars / w, again / w,
             sum(map(eq, words, words[1:])) / w]
    return [n, word_chars, symbols, dup_lines, repeats], rules


def vote(values: list[float]) -> str:
    """A letter for each rule: b(ad), g(ood) or a(bstains). A rule with a good mark is better the higher its measure."""
    out = []
    for v, (bad, good) in zip(values, RULES.values()):
        if good is None:
            out.append("b" if v >= bad else "a")
        else:
            out.append("b" if v <= bad else "g" if v >= good else "a")
    return "".join(out)


def base_failed(n: int, repeats: int) -> bool:
    return n < MIN_WORDS or 100 * repeats > REPEAT_PERCENT * n


def with_votes(docs: DataFrame, names: list[str], text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (all by default), the five base counts, base_failed and the vote pattern, under ``names``."""

    def make():
        def fn(texts):
            rows = []
            for t in texts:
                base, values = measures(t)
                rows.append([*base, base_failed(base[0], base[4]), vote(values)])
            return [list(x) for x in zip(*rows)] or [[]] * 7
        return fn

    fields = list(zip(names, ["bigint"] * 5 + ["boolean", "string"]))
    return map_texts(docs, make, fields, docs.columns if keep is None else keep, [text])


def fit(patterns: dict[str, int], rounds: int = 200) -> dict[str, float]:
    """Posterior probability of *good* of each vote pattern, by expectation-maximisation over pattern counts.

    A rule votes b, g or a with probabilities that depend on the class alone. The start, and Dirichlet pseudo-counts worth a
    fifth of the documents, say that a vote is right more often than not, which also fixes which class is which.
    """
    keys = sorted(patterns)
    if not keys:
        return {}
    weight = np.array([patterns[k] for k in keys], dtype=float)
    total = weight.sum()
    onehot = np.array([[[c == x for x in "bga"] for c in k] for k in keys], dtype=float)  # pattern, rule, vote
    start = np.array([START[good is not None] for _, good in RULES.values()]).swapaxes(0, 1)  # class (bad, good), rule, vote
    pseudo = max(1.0, PSEUDO * total) * start
    theta = start
    prior = np.array([1 - PRIOR_GOOD, PRIOR_GOOD])
    for _ in range(rounds):
        log = np.log(prior) + np.einsum("prv,crv->pc", onehot, np.log(theta))
        log -= log.max(axis=1, keepdims=True)
        post = np.exp(log)
        post /= post.sum(axis=1, keepdims=True)
        counts = np.einsum("pc,prv->crv", post * weight[:, None], onehot) + pseudo
        theta = counts / counts.sum(axis=2, keepdims=True)
        new = (post * weight[:, None]).sum(axis=0) + PSEUDO * total * np.array([1 - PRIOR_GOOD, PRIOR_GOOD])
        new /= new.sum()
        if np.abs(new - prior).max() < 1e-9:
            break
        prior = new
    return dict(zip(keys, post[:, 1].tolist()))


def posterior_of(votes: DataFrame, pattern: str, failed: str) -> dict[str, float]:
    """Counts the patterns of all documents (at most 3^rules) and fits; documents that failed the base count as well."""
    counted = votes.groupBy(F.col(pattern).alias("p")).count().collect()
    return fit({r["p"]: r["count"] for r in counted})


def judged(docs: DataFrame, names: list[str], text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns, then under the eight ``names``: the five counts, base_failed, the posterior and kept.

    A document is kept if it passes the base rules and its posterior is at least a half. Null and empty texts have no
    words and fail; equal texts have equal results; an empty table fits nothing and stays empty.
    """
    spark = docs.sparkSession
    keep = docs.columns if keep is None else keep
    pattern = free_name(docs, "_votes")
    while pattern in names:
        pattern = "_" + pattern
    votes = written(with_votes(docs, [*names[:6], pattern], text, keep), "votes")
    table = posterior_of(votes, pattern, names[5])
    # one row for each pattern: bounded by 3^rules, not by the documents
    known = spark.createDataFrame(list(table.items()), f"{quoted(pattern)} string, {quoted(names[6])} double")
    out = votes.join(F.broadcast(known), pattern, "left")
    kept = ~F.col(names[5]) & (F.col(names[6]) >= THRESHOLD)
    return out.select(*columns([*keep, *names[:7]]), F.coalesce(kept, F.lit(False)).alias(names[7]))


NAMES = [*[n for n, _ in BASE], "base_failed", "posterior", "kept"]


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents that are kept, with their own columns."""
    names = [free_name(docs, n) for n in NAMES]
    return judged(docs, names, text).where(F.col(names[7])).select(*columns(docs.columns))
