"""BPE encoding and decoding by speculation and verification.

Greedy longest match proposes the tokens of a word. A sequence of tokens is the BPE encoding of its word exactly when every
adjacent pair is compatible, that is when the two tokens' joined symbols encode to just these two tokens. The pairs of a batch
are tested together against a table of verdicts; words with a failing pair are merged exactly, in order of rank.

Null and empty texts have no tokens. The vocabulary is read once by the driver from ``path`` and broadcast: it is a file of
fixed size, not data.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adloom.llm.common import forget_others, map_text

# Words and verdicts on pairs kept between batches by one worker. Beyond it a memory starts anew; results do not depend on it.
MEMORY_WORDS = 150_000
MEMORY_PAIRS = 300_000
UNRANKED = 1 << 60

# How the vocabulary's format cuts a text into words. White space is listed, as engines differ about it.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
ENDINGS = r"'s|'t|'re|'ve|'m|'ll|'d"
ASCII_WORDS = re.compile(rf"{ENDINGS}|[a-z]+|[0-9]|[^\t-\r a-z0-9]+")
ANY_WORDS = regex.compile(rf"{ENDINGS}|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+")


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte: itself if it prints, else the next one from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class Vocabulary:
    """Tokens, merge ranks and pair verdicts of one vocabulary file, in symbols: byte values, plus 256 at the end of a word."""

    def __init__(self, content: str) -> None:
        spec = json.loads(content)
        model = spec["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        alphabet = {c: b for b, c in enumerate(byte_alphabet())}

        def symbols(token: str) -> str:
            ends = bool(self.suffix) and token.endswith(self.suffix)
            body = [alphabet[c] for c in (token[: -len(self.suffix)] if ends else token)]
            if ends:
                body[-1] += 256
            return "".join(map(chr, body))

        self.shown = {i: t for t, i in model["vocab"].items()}
        self.ids = {symbols(t): i for t, i in model["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.shown |= {i: t for t, i in self.special.items()}
        self.width = max(self.shown) + 1
        merges = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = map(symbols, pair if isinstance(pair, list) else pair.split(" "))
            merges.setdefault(self.ids[left] * self.width + self.ids[right], (rank, self.ids[left + right]))
        # Sorted by pair: rank and product of each merge, with one entry past the end that matches nothing.
        self.pairs = np.array([*sorted(merges), -1], np.int64)
        self.ranks, self.products = (np.array([merges[p][k] for p in self.pairs[:-1].tolist()] + [UNRANKED], np.int64) for k in (0, 1))
        self.single = np.array([self.ids.get(chr(s), -1) for s in range(512)], np.int64)
        self.symbols = {i: s for s, i in self.ids.items()}
        self.bytes = {i: i.to_bytes(4, "little") for i in self.shown}
        # A token that its own merges do not produce can never occur, so it must not be proposed.
        made = self.merge(list(self.ids))
        self.proposable = {s: i for (s, i), m in zip(self.ids.items(), made, strict=True) if m == [i]}
        # Longest token for each two leading symbols.
        self.longest: dict[str, int] = {}
        for s in self.proposable:
            self.longest[s[:2]] = max(self.longest.get(s[:2], 1), len(s))
        self.verdicts: dict[int, bool] = {}
        self.split = regex.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")

    def rank(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and product of each pair; unranked pairs cannot merge."""
        key = left * self.width + right
        at = np.searchsorted(self.pairs[:-1], key)
        at[self.pairs[at] != key] = len(self.pairs) - 1
        return self.ranks[at], self.products[at]

    def merge(self, words: list[str]) -> list[list[int]]:
        """Exact merging of many words side by side: in each, always the pair of lowest rank, the leftmost of equals."""
        out: list[list[int]] = [[]] * len(words)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        parts = self.single[np.frombuffer("".join(words).encode("utf-16-le"), "<u2")]
        owner = np.repeat(np.arange(len(words)), lengths)
        ranks, products = np.full(len(parts), UNRANKED), np.zeros(len(parts), np.int64)
        if len(parts) > 1:  # The rank at a part is that of the pair it begins; none begins at the end of a word.
            ranks[:-1], products[:-1] = self.rank(parts[:-1], parts[1:])
            ranks[:-1][owner[1:] != owner[:-1]] = UNRANKED
        while len(parts):
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            sizes = np.diff(np.r_[first, len(parts)])
            least = np.minimum.reduceat(ranks, first)
            done = least == UNRANKED
            if done.any():
                ended = np.repeat(done, sizes)
                flat, ends = parts[ended].tolist(), np.cumsum(sizes[done]).tolist()
                for w, stop, n in zip(owner[first[done]].tolist(), ends, sizes[done].tolist(), strict=True):
                    out[w] = flat[stop - n : stop]
                live = ~ended
                parts, owner, ranks, products = parts[live], owner[live], ranks[live], products[live]
                first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(parts) else first[:0]
                least, sizes = least[~done], sizes[~done]
                if not len(parts):
                    break
            hits = np.flatnonzero(ranks == np.repeat(least, sizes))
            at = hits[np.r_[True, owner[hits[1:]] != owner[hits[:-1]]]]
            parts[at] = products[at]
            keep = np.ones(len(parts), bool)
            keep[at + 1] = False
            at = at - np.arange(len(at))
            parts, owner, ranks, products = parts[keep], owner[keep], ranks[keep], products[keep]
            for p in (at, at[at > 0] - 1):
                inner = (p + 1 < len(parts)) & (owner[np.minimum(p + 1, len(parts) - 1)] == owner[p])
                ranks[p] = UNRANKED
                q = p[inner]
                ranks[q], products[q] = self.rank(parts[q], parts[q + 1])
        return out

    def propose(self, word: str) -> list[int]:
        """Greedy longest match."""
        out, at, end, known, longest = [], 0, len(word), self.proposable, self.longest
        while at < end:
            stop = min(end, at + longest.get(word[at : at + 2], 1))
            while (i := known.get(word[at:stop])) is None:
                stop -= 1
            out.append(i)
            at = stop
        return out

    def failing(self, proposals: list[list[int]]) -> np.ndarray:
        """Which proposals hold an incompatible pair: one look over all adjacent pairs of the batch."""
        lengths = np.fromiter(map(len, proposals), np.int64, len(proposals))
        flat = np.fromiter((i for p in proposals for i in p), np.int64, int(lengths.sum()))
        owner = np.repeat(np.arange(len(proposals)), lengths)
        inner = owner[1:] == owner[:-1]
        pairs = (flat[:-1] * self.width + flat[1:])[inner]
        kinds, back = np.unique(pairs, return_inverse=True)
        good = self.compatible(kinds.tolist())
        bad = np.zeros(len(proposals), bool)
        bad[owner[1:][inner][~good[back]]] = True
        return bad

    def compatible(self, pairs: list[int]) -> np.ndarray:
        """Whether two tokens, joined, encode to themselves. New pairs are merged together and remembered."""
        new = [p for p in pairs if p not in self.verdicts]
        if len(self.verdicts) + len(new) > MEMORY_PAIRS:
            self.verdicts, new = {}, list(pairs)
        tokens = [divmod(p, self.width) for p in new]
        for pair, both, made in zip(new, tokens, self.merge([self.symbols[a] + self.symbols[b] for a, b in tokens]), strict=True):
            self.verdicts[pair] = made == list(both)
        return np.fromiter(map(self.verdicts.__getitem__, pairs), bool, len(pairs))

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Ids of words, which are texts without white space that the word pattern has cut."""
        forms = []
        for word in words:
            raw = word.encode()
            forms.append(raw[:-1].decode("latin-1") + chr(raw[-1] + (256 if self.suffix else 0)))
        proposals = [self.propose(w) for w in forms]
        failed = np.flatnonzero(self.failing(proposals)).tolist()
        for k, ids in zip(failed, self.merge([forms[k] for k in failed]), strict=True):
            proposals[k] = ids
        return proposals

    def words_of(self, text: str) -> list[str]:
        """Words of a text in order; special tokens come as ``Special``."""
        if not text:
            return []
        out, at = [], 0
        if "<|" in text or not all(s.startswith("<|") for s in self.special):
            for m in self.split.finditer(text):
                out += plain_words(text[at : m.start()])
                out.append(Special(m.group()))
                at = m.end()
        return out + plain_words(text[at:]) if at else plain_words(text)


class Special(str):
    """A special token met in a text; never equal to a word of the same letters."""

    __slots__ = ()

    def __hash__(self) -> int:
        return hash(("special", str(self)))

    def __eq__(self, other: object) -> bool:
        return isinstance(other, Special) and str.__eq__(self, other)


def plain_words(text: str) -> list[str]:
    if text.isascii():
        return ASCII_WORDS.findall(text.lower())
    text = unicodedata.normalize("NFC", text)
    # Letter by letter: the rule for a sigma at the end of a word does not apply.
    text = "".join(c.lower() for c in text) if "Σ" in text else text.lower()
    return ANY_WORDS.findall(text)


@lru_cache(maxsize=2)
def vocabulary(content: str) -> Vocabulary:
    return Vocabulary(content)


class Coder:
    """Encodes and decodes texts with a memory of words: their ids as bytes and their decoded form."""

    def __init__(self, vocab: Vocabulary) -> None:
        self.vocab, self.bytes, self.shown = vocab, {}, {}

    def learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.bytes]
        if len(self.bytes) + len(new) > MEMORY_WORDS:
            self.bytes, self.shown, new = {}, {}, list(words)
        plain = [w for w in new if not isinstance(w, Special)]
        form, name = self.vocab.bytes, self.vocab.shown
        coded = zip(plain, self.vocab.encode_words(plain), strict=True) if plain else ()
        for word, ids in [*coded, *((w, [self.vocab.special[str(w)]]) for w in new if isinstance(w, Special))]:
            self.bytes[word] = b"".join([form[i] for i in ids])
            self.shown[word] = " ".join([name[i] for i in ids])

    def code(self, texts: list[str | None]) -> tuple[list[bytes], list[str]]:
        """Per text: ids as little-endian 32-bit integers, and the decoded text."""
        cut = [self.vocab.words_of(t) if t else [] for t in texts]
        self.learn(set().union(*cut))
        ids, shown = self.bytes, self.shown
        return [b"".join([ids[w] for w in c]) for c in cut], [" ".join([shown[w] for w in c]) for c in cut]


_CODERS: dict[int, Coder] = {}


def coder(content: str) -> Coder:
    key = hash(content)
    if key not in _CODERS:
        forget_others(__name__)
        _CODERS.clear()
        _CODERS[key] = Coder(vocabulary(content))
    return _CODERS[key]


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``ids`` (array<int>) and ``decoded`` of every whole text; any other column is left out."""
    content = _broadcast(docs, path)

    def run(batch: pa.RecordBatch) -> dict:
        ids, shown = coder(content.value).code(batch.column("_text").to_pylist())
        return {"_id": batch.column("_id"), "ids": [np.frombuffer(b, "<u4").astype(np.int32) for b in ids], "decoded": shown}

    kind = docs.schema[id_col].dataType.simpleString()
    out = map_text(_narrow(docs, id_col, text_col), "_text", run, f"_id {kind}, ids array<int>, decoded string")
    return out.withColumnRenamed("_id", id_col)


def digest(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", ids: bool = False) -> DataFrame:
    """Number of tokens and digests of ids and decoded text, made where the texts are; with the ids themselves if asked."""
    content = _broadcast(docs, path)

    def run(batch: pa.RecordBatch) -> dict:
        coded, shown = coder(content.value).code(batch.column("_text").to_pylist())
        out = {
            "_id": batch.column("_id"), "n_tokens": [len(b) // 4 for b in coded],
            "ids_sha256": [hashlib.sha256(b).hexdigest() for b in coded],
            "decoded_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in shown],
        }
        return out | {"ids": [np.frombuffer(b, "<u4").astype(np.int32) for b in coded]} if ids else out

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if ids else "")
    return map_text(_narrow(docs, id_col, text_col), "_text", run, schema).withColumnRenamed("_id", id_col)


def decode(ids: list[int], vocab: Vocabulary) -> str:
    """The tokens' own forms with blanks between them, special tokens included."""
    return " ".join(vocab.shown[i] for i in ids)


def _narrow(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))


def _broadcast(docs: DataFrame, path: str):
    with open(path, encoding="utf-8") as f:
        return docs.sparkSession.sparkContext.broadcast(f.read())
