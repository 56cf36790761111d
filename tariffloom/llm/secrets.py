"""Secret scans: fixed patterns, and dictionary-primed zstandard novelty for what no pattern names.

Patterns (leftmost, non-overlapping per kind, code-point spans, end exclusive):
``assign`` a credential word, an equals sign or colon and a value of 8 or more characters; ``access`` AKIA and 16 or more
characters in all; ``hex`` 32 or more hexadecimal digits.

Novelty: a candidate is a run of ``[A-Za-z0-9+/_=-]``, or what the patterns' spans leave of one, of at least ``SHORT``
characters, with a sensitive word within ``CONTEXT`` characters on either side. Its novelty is the number of compressed bytes it
adds to its surroundings: zstandard, primed with a dictionary of code and identifier words, compresses the
surroundings with and without it. A candidate that adds at least ``NOVEL`` bytes a character can't be said from its
context or from known identifiers; it is reported as ``novel``. A few characters always look new, so a candidate below ``LEAST``
characters must add ``NOVEL_SHORT`` bytes a character and change its class (digits, small and capital letters) at least ``TURNS`` times, a
first capital aside: words of any language and plain numbers don't.

A map over whole texts without a shuffle. Cases: NULL and empty texts have no span; very long texts are scanned whole;
rows that repeat are reported one by one; an empty table gives an empty result; extra columns are ignored by
``scan`` and kept by ``redacted``.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tariffloom.llm.common import map_batches

KINDS = ("assign", "access", "hex", "novel")
#: The base patterns. The shortest length stands in the patterns where a greedy run decides it.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_WORDS = ("passw", "secret", "token", "api")

SHORT, LEAST, CONTEXT, NOVEL, NOVEL_SHORT, TURNS = 8, 20, 64, 0.6, 0.8, 3
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-]{{{SHORT},}}")
TURN = re.compile(r"[0-9](?=[A-Za-z])|[A-Za-z](?=[0-9])|[a-z](?=[A-Z])|(?<=.)[A-Z](?=[a-z])")
SENSITIVE = re.compile(
    r"passw|passphrase|secret|token|api[ _-]?key|credential|bearer|authorization|private[ _-]?key|access[ _-]?key|client[ _-]?id|"
    r"signature|akia|ssh-|\bauth\b", re.IGNORECASE | re.ASCII)
#: Identifier words that prime the compressor, most frequent last as the format prefers.
IDENTIFIERS = (
    "abstract async await boolean break byte case catch char class const continue default delete double else enum except "
    "export extends final finally float for from function global if implements import in instanceof int interface lambda long "
    "module namespace new null package pass private protected public raise return self short static string struct super switch "
    "this throw true try typedef undefined union unsigned using var virtual void while with yield "
    "account address admin array balance buffer bucket cache callback channel client cluster column config connection context "
    "controller cookie counter database date debug decode device digest directory document domain download driver email "
    "encode endpoint engine environment error event exception executor expires file filter folder format frame group handler hash "
    "header host index input instance issuer item iterator job json key label language length level library limit list listener "
    "location logger login manager map memory message method model name network node number object offset operator option "
    "order output owner page parameter parent parser partition path pattern payload permission pointer policy pool port "
    "prefix process product profile project property protocol provider proxy query queue range record region registry "
    "release remote repository request resource response result role root route row sample schema scope script secret "
    "segment select sender sequence serializer server service session setting shard size source stack start state status "
    "storage stream subject suffix table tag target task template tenant test text thread timeout timestamp title token "
    "topic transaction transform tree type update upload uri url user username util value variable vector version view "
    "volume width window worker writer 0123456789 abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ get_ set_ is_ has_ to_ "
    "from_ on_ .get( .set( = \" \": \" key= token= secret= password= https://www. http:// .com/ .org/ .net/ /api/v1/ "
)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the patterns."""
    spans = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


class Novelty:
    """Marginal compressed bytes of a string in its surroundings."""

    def __init__(self, words: str = IDENTIFIERS):
        primed = zstandard.ZstdCompressionDict(words.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.compressor = zstandard.ZstdCompressor(level=19, dict_data=primed, write_content_size=False)

    def added(self, before: str, candidate: str, after: str) -> int:
        around = len(self.compressor.compress((before + after).encode()))
        return len(self.compressor.compress((before + candidate + after).encode())) - around

    def spans(self, text: str, known: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """(start, kind, end) of what no pattern names; ``known``: the patterns' spans, by start."""
        words = [m.span() for m in SENSITIVE.finditer(text)]
        if not words:
            return []
        starts, ends = [s for s, _ in words], [e for _, e in words]
        out = []
        for start, end in unnamed(text, known):
            if not (bisect_left(starts, start - CONTEXT) < bisect_right(ends, start) or bisect_left(starts, end) < bisect_right(ends, end + CONTEXT)):
                continue
            word = text[start:end]
            short = len(word) < LEAST
            if short and len(TURN.findall(word)) < TURNS:
                continue
            before, after = text[max(start - CONTEXT, 0):start], text[end:end + CONTEXT]
            if self.added(before, word, after) >= (NOVEL_SHORT if short else NOVEL) * len(word):
                out.append((start, 3, end))
        return out


def unnamed(text: str, known: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """Runs of candidate characters, without what ``known`` spans cover; both walk forward together."""
    at = 0
    for m in CANDIDATE.finditer(text):
        start, end = m.span()
        while at < len(known) and known[at][2] <= start:
            at += 1
        k = at
        while k < len(known) and known[k][0] < end:
            if known[k][0] - start >= SHORT:
                yield start, known[k][0]
            start = max(start, known[k][2])
            k += 1
        if end - start >= SHORT:
            yield start, end


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, n_novel, base_sha256, spans (kind:start:end, by start, then kind)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        novelty = Novelty()
        for batch in batches:
            rows = []
            for value in batch.column(1).to_pylist():
                base = base_spans(value or "")
                new = novelty.spans(value or "", base)
                counts = [sum(s[1] == k for s in base) for k in range(3)]
                rows.append((*counts, len(new), hashlib.sha256(joined(base).encode()).hexdigest(), joined(sorted(base + new))))
            cols = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, pa.int64()) for c in cols[:4]], *[pa.array(c, pa.string()) for c in cols[4:]]],
                names=["doc_id", "n_assign", "n_access", "n_hex", "n_novel", "base_sha256", "spans"])

    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_batches(
        rows, run, f"doc_id {kind}, n_assign long, n_access long, n_hex long, n_novel long, base_sha256 string, spans string")


def masked(text: str, spans: list[tuple[int, int, int]], mask: str) -> str:
    """Overlapping spans become one mask."""
    out, at = [], 0
    for start, _, end in spans:
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame, mask: str = "[SECRET]", text: str = "text", size: str = "n_chars") -> DataFrame:
    """``docs`` with every span replaced by ``mask``; the column ``size``, where there is one, is the new length."""
    at = docs.columns.index(text)
    sized = docs.columns.index(size) if size in docs.columns else -1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        novelty = Novelty()
        for batch in batches:
            columns, texts, sizes = list(batch.columns), [], batch.column(sized).to_pylist() if sized >= 0 else []
            for i, value in enumerate(batch.column(at).to_pylist()):
                base = base_spans(value or "")
                spans = sorted(base + novelty.spans(value or "", base))
                texts.append(masked(value, spans, mask) if spans else value)
                if spans and sized >= 0:
                    sizes[i] = len(texts[-1])
            columns[at] = pa.array(texts, columns[at].type)
            if sized >= 0:
                columns[sized] = pa.array(sizes, columns[sized].type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return map_batches(docs, run, docs.schema)
