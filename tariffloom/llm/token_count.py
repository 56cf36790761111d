"""Token counts by rank-synchronous array merging.

A byte-pair vocabulary splits a text into pre-tokens and merges adjacent symbols of each by rank. Here the pre-tokens of
a batch that aren't known yet lie side by side in one ragged numpy array. In each round every sequence finds its lowest-
ranked adjacent pair, and all sequences apply theirs at once (equal pairs of a run from the left, not overlapping). When no
pair has a rank left, the surviving symbols are counted. Counts of short pre-tokens are kept for the next batches.

That a sequence may apply all places of its lowest pair at once needs merges that never make a pair of lower rank than
the merge that made its symbols; ``Merges`` checks this for the vocabulary. Where it doesn't hold, only the leftmost
place is merged in each round, which is the rule itself.

Files: the JSON of a byte-level vocabulary with word ends: NFC, white space to blanks, lower case; words are found by a
pattern and white space is dropped; special strings inside a text are tokens of their own. Texts of characters for which
the standard library and the vocabulary's own normalizer could differ take that library's normalizer and splitter for
the pre-tokens; the merging is the same.

A map over whole texts without a shuffle; the vocabulary is read by each worker from ``path``, a parameter. Cases: NULL
and empty texts have no bytes and no tokens; very long texts and words are counted whole; rows that repeat are counted
one by one; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tariffloom.llm.common import map_batches

#: Texts of these characters only take the quick way: letters and marks that NFC leaves alone and whose lower case and classes
#: are the same everywhere; control characters, the dotted capital I and modifier letters are left out.
QUICK = re.compile(r"[\t\n\r\x20-\x7e\xa0-\xac\xae-įı-ǃ‐-‧‰-⁞]*")
REMEMBERED = 400_000
#: Longer pre-tokens are counted again each time.
SHORT = 48
#: Bytes of pre-tokens merged at a time.
ROUND = 4 << 20


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: printable bytes are themselves, the others follow 255."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Merges:
    """Merge table as sorted arrays: pair key -> rank and made symbol."""

    def __init__(self, path: str):
        model = json.loads(open(path, encoding="utf-8").read())["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"] or ""
        self.size = max(vocab.values()) + 1
        symbols = byte_symbols()
        self.inner = np.array([vocab.get(s, -1) for s in symbols], np.int64)
        self.last = np.array([vocab.get(s + end, -1) for s in symbols], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left, right = (np.array([vocab[p[k]] for p in pairs], np.int64) for k in (0, 1))
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        rank = np.arange(len(pairs))
        keys = left * self.size + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank, self.made = keys[order], rank[order], made[order]
        by_rank = np.full(len(pairs) + 1, -1, np.int64)
        by_rank[:-1] = made
        self.made_by_rank = by_rank
        latest = np.full(self.size, -1)
        np.maximum.at(latest, made, rank)
        self.together = bool((np.maximum(latest[left], latest[right]) < rank).all())

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; the number of merges where there is none."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank[at], len(self.keys))

    def counts(self, words: list[bytes]) -> np.ndarray:
        """Symbols that survive in each of ``words`` (not empty)."""
        lengths = np.array([len(w) for w in words], np.int64)
        raw = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum(lengths)
        symbols = self.inner[raw]
        symbols[ends - 1] = self.last[raw[ends - 1]]
        owner = np.repeat(np.arange(len(words)), lengths)
        out = lengths.copy()
        none = len(self.keys)
        while len(symbols) > 1:
            rank = self.ranks(symbols[:-1], symbols[1:])
            rank[owner[:-1] != owner[1:]] = none
            # lowest rank of each sequence; starts are where the owner changes
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            lowest = np.minimum.reduceat(np.r_[rank, none], starts)
            sizes = np.diff(np.r_[starts, len(owner)])
            alive = np.repeat(lowest < none, sizes)
            if not alive.any():
                break
            hit = rank == np.repeat(lowest, sizes)[:-1]
            hit &= rank < none
            at = np.flatnonzero(hit)
            if self.together:
                # places next to each other share a symbol: from the left, every second one of a run counts
                fresh = np.r_[True, np.diff(at) > 1]
                run = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
                at = at[(np.arange(len(at)) - run) % 2 == 0]
            else:
                at = at[np.r_[True, owner[at][1:] != owner[at][:-1]]]
            out -= np.bincount(owner[at], minlength=len(out))
            symbols[at] = self.made_by_rank[rank[at]]
            keep = alive  # finished sequences leave the array
            keep[at + 1] = False
            symbols, owner = symbols[keep], owner[keep]
        return out


class Counter:
    """Token counts of texts for one vocabulary file."""

    def __init__(self, path: str):
        self.merges = Merges(path)
        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(open(path, encoding="utf-8").read())
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = regex.compile(split["pattern"]["Regex"])
        specials = [t["content"] for t in spec["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, sorted(specials, key=len, reverse=True)))) if specials else None
        self.known: dict[str, int] = {}

    def pieces(self, text: str) -> tuple[int, list[str]]:
        """Number of special strings, and the pre-tokens of what lies between them."""
        parts = self.special.split(text) if self.special and "<" in text else [text]
        words: list[str] = []
        for part in parts:
            if QUICK.fullmatch(part):
                words += self.pattern.findall(part.lower())
            else:
                plain = self.tokenizer.normalizer.normalize_str(part)
                words += self.pattern.findall(plain) if QUICK.fullmatch(plain) else [
                    plain[s:e] for _, (s, e) in self.tokenizer.pre_tokenizer.pre_tokenize_str(plain)]
        return len(parts) - 1, words

    def learn(self, words: set[str]) -> None:
        """Count the words that aren't known yet, in rounds of bounded size."""
        held, size = [], 0
        for word in words:
            held.append(word)
            size += len(word)
            if size > ROUND:
                self.known.update(zip(held, self.merges.counts([w.encode() for w in held]).tolist()))
                held, size = [], 0
        if held:
            self.known.update(zip(held, self.merges.counts([w.encode() for w in held]).tolist()))

    def count(self, texts: list[str]) -> list[int]:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        out, group, size = [], [], 0

        def close() -> None:
            self.learn({w for _, words in group for w in words if w not in self.known})
            out.extend(n + sum(map(self.known.__getitem__, words)) for n, words in group)
            for w in [w for w in self.known if len(w) > SHORT]:
                del self.known[w]
            group.clear()

        for text in texts:
            group.append(self.pieces(text))
            size += len(text)
            if size > ROUND:
                close()
                size = 0
        close()
        return out


def token_counts(docs: DataFrame, path: str, limit: int = 2048, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_bytes (UTF-8), n_tokens, over_limit (more than ``limit`` tokens)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        counter = Counter(path)
        for batch in batches:
            counts = counter.count([x or "" for x in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(counts, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"),
        F.coalesce(F.octet_length(f"`{text}`"), F.lit(0)).cast("long").alias("n_bytes"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    counted = map_batches(rows, run, f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
