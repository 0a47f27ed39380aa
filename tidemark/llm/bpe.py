"""BPE encoding and decoding by dynamic programming over prefixes.

For every prefix of a piece there is exactly one last token that the merge procedure can leave there. A suffix
automaton over the vocabulary lists the tokens that end at a position; the right one is the one that is *compatible*
with the last token of the prefix before it, which is decided by undoing merges on both sides of their border. Back-
pointers from the end give the ids. The work is linear in the piece, whatever its length; no merges are replayed.

The reader understands files of the ``tokenizers`` library that hold a byte-level BPE with an end-of-word suffix, the
normalisers NFC, white space to one space and lower case, and a splitting pattern.
"""

from __future__ import annotations

import json
import struct
import unicodedata

import ahocorasick
import regex
from pyspark.sql import DataFrame

from tidemark.llm.shared import map_texts

#: Distinct pieces of the younger of two generations that a Python worker remembers, the longest piece it remembers (longer ones
#: are encoded each time), and the pairs of tokens it remembers.
CACHE_PIECES, CACHE_CHARS, CACHE_PAIRS = 100_000, 64, 300_000


def byte_letters() -> list[str]:
    """The letter that stands for each byte in the file: printable ones for themselves, others from 256 upwards."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


def load(path: str) -> dict:
    """What encoding needs of a tokenizer file, as plain values; read on the driver and broadcast (a few MB)."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model = spec["model"]
    kinds = [x["type"] for x in spec["normalizer"]["normalizers"]]
    split, level = spec["pre_tokenizer"]["pretokenizers"]
    if (model["type"], kinds, split["invert"], level["type"], model["continuing_subword_prefix"] or "", spec["decoder"]) != (
            "BPE", ["NFC", "Replace", "Lowercase"], True, "ByteLevel", "", None):
        raise ValueError(f"{path}: not the kind of tokenizer this reader knows")
    vocab = model["vocab"]
    return {
        "vocab": sorted(vocab, key=vocab.get), "ids": sorted(vocab.values()), "end": model["end_of_word_suffix"] or "",
        "merges": [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]],
        "pattern": split["pattern"]["Regex"], "added": {x["content"]: x["id"] for x in spec["added_tokens"]},
    }


class Bpe:
    """Encoder and decoder of one tokenizer."""

    def __init__(self, spec: dict):
        self.letters = byte_letters()
        self.end = spec["end"]
        self.token = dict(zip(spec["ids"], spec["vocab"]))
        id_of = {s: i for i, s in self.token.items()}
        self.added = spec["added"]
        self.token.update({i: s for s, i in self.added.items()})
        self.splitter = regex.compile(spec["pattern"])
        self.cut = regex.compile("(" + "|".join(regex.escape(x) for x in self.added) + ")") if self.added else None
        # undoing a merge: the two tokens a token was made of, and the merge's rank; base tokens have none
        self.rank: dict[int, int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.joined: dict[tuple[int, int], int] = {}
        for rank, (a, b) in enumerate(spec["merges"]):
            new = id_of[a + b]
            self.joined[id_of[a], id_of[b]] = new
            self.rank[new] = rank
            self.parts[new] = (id_of[a], id_of[b])
        self.automaton = ahocorasick.Automaton()
        for s, i in id_of.items():
            if i in self.parts or len(self._symbols_of(s)) == 1:
                symbols = self._symbols_of(s)
                self.automaton.add_word(symbols, (len(symbols), i))
        self.automaton.make_automaton()
        self.known: dict[str, tuple[bytes, str]] = {}
        self.older: dict[str, tuple[bytes, str]] = {}
        self.pairs: dict[int, bool] = {}

    def _symbols_of(self, s: str) -> str:
        """One character per base symbol: a letter, or the last letter of a word, moved out of the letters' range."""
        if self.end and s.endswith(self.end) and len(s) > len(self.end):
            s = s[:-len(self.end)]
            return s[:-1] + chr(ord(s[-1]) + 1024)
        return s

    def compatible(self, a: int, b: int) -> bool:
        """Whether merging left to right by rank can leave ``a`` and ``b`` side by side.

        The later of the two merges is undone, step by step; if the two tokens at the border would have been merged
        before that, the pair cannot stand.
        """
        top = len(self.rank) + 1
        limit = top
        rank, parts = self.rank, self.parts
        while True:
            new = self.joined.get((a, b))
            if new is not None and rank[new] < limit:
                return False
            ra, rb = rank.get(a, -1), rank.get(b, -1)
            if ra > rb:
                # the left token was finished last; before that, its right half stood at the border
                limit, a = ra, parts[a][1]
            elif rb >= 0:
                # among equal merges the left one goes first, so the right token yields to an equal rank, too
                limit, b = rb + 1, parts[b][0]
            else:
                return True

    def piece_ids(self, piece: str) -> list[int]:
        """Ids of one piece of the splitter."""
        letters = self.letters
        s = "".join([letters[b] for b in piece.encode()])
        if self.end:
            s = s[:-1] + chr(ord(s[-1]) + 1024)
        last: list[tuple[int, int] | None] = [None] * len(s)  # (length, id) of the last token of each prefix
        pairs = self.pairs
        for at, found in self.automaton.iter(s):
            if last[at] is not None:
                continue
            start = at - found[0]
            if start < 0:
                last[at] = found
            elif (before := last[start]) is not None:
                pair = before[1] << 32 | found[1]
                ok = pairs.get(pair)
                if ok is None:
                    if len(pairs) >= CACHE_PAIRS:
                        pairs.clear()
                    ok = pairs[pair] = self.compatible(before[1], found[1])
                if ok:
                    last[at] = found
        ids, at = [], len(s) - 1
        while at >= 0:
            if last[at] is None:
                raise ValueError(f"no token for a symbol of {piece!r}")
            length, token = last[at]
            ids.append(token)
            at -= length
        return ids[::-1]

    def _remember(self, piece: str) -> tuple[bytes, str]:
        got = self.older.get(piece)
        if got is None:
            ids = self.piece_ids(piece)
            got = (struct.pack(f"<{len(ids)}I", *ids), " ".join([self.token[i] for i in ids]))
        if len(piece) <= CACHE_CHARS:
            if len(self.known) >= CACHE_PIECES:
                self.older = self.known.copy()
                self.known.clear()
            self.known[piece] = got
        return got

    def pieces(self, text: str) -> list[str]:
        """Normalised text, cut by the splitter."""
        if text.isascii():
            return self.splitter.findall(text.lower())
        # the library lower-cases letter by letter; Python alone looks around a final sigma
        return self.splitter.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers; a null text is empty."""
        out, known = [], self.known
        for part in self._parts(text):
            if part in self.added:
                out.append(struct.pack("<I", self.added[part]))
            else:
                out += [(known.get(p) or self._remember(p))[0] for p in self.pieces(part)]
        return b"".join(out)

    def encode_and_decode(self, text: str | None) -> tuple[bytes, str]:
        """The ids, and the text that ``decode`` gives for them, in one pass over remembered pieces."""
        ids, words, known = [], [], self.known
        for part in self._parts(text):
            if part in self.added:
                ids.append(struct.pack("<I", self.added[part]))
                words.append(part)
                continue
            found = [known.get(p) or self._remember(p) for p in self.pieces(part)]
            ids += [f[0] for f in found]
            words += [f[1] for f in found]
        return b"".join(ids), " ".join(words)

    def _parts(self, text: str | None) -> list[str]:
        if not text:
            return []
        if self.cut is None or "<|" not in text and not self.cut.search(text):
            return [text]
        return [x for x in self.cut.split(text) if x]

    def decode(self, ids: bytes) -> str:
        """The library's text for ids: without a decoder in the file, the tokens joined by spaces."""
        return " ".join([self.token[i] for (i,) in struct.iter_unpack("<I", ids)])


def tokenized(docs: DataFrame, path: str, text: str = "text", keep: list[str] | None = None,
              names: tuple[str, str] = ("ids", "decoded")) -> DataFrame:
    """``keep`` columns (all by default) plus the ids (binary, little-endian 32 bit) and the decoded text; they replace columns of their ``names``.

    A null or empty text has no ids and an empty decoded text. Every row stands alone, so copies, repeated rows and an
    empty table need no care. A text is held whole, one batch at a time; the memory of pieces is bounded.
    """
    spec = docs.sparkSession.sparkContext.broadcast(load(path))

    def make():
        # kept with the broadcast value, so a Python worker that runs several tasks builds it once
        model = spec.value.get("model") or spec.value.setdefault("model", Bpe(spec.value))

        def fn(texts):
            got = [model.encode_and_decode(t) for t in texts]
            return [[g[0] for g in got], [g[1] for g in got]]
        return fn

    return map_texts(docs, make, [(names[0], "binary"), (names[1], "string")], docs.columns if keep is None else keep, [text])


def default_path() -> str:
    """The file the queries use; only its path is known here, the file is not part of the repository."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
