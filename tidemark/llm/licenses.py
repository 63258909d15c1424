"""License scans by canonical digest lookup.

Texts and known licences go through one canonical form: no copyright lines, lower case, equivalent spellings made one,
punctuation and white space one space. Entire canonical texts are hashed and joined with the digests of the known
licences. Entire are: the document, each of its paragraphs, lines and sentences, and runs of whole paragraphs. A text is
split into canonical words once, with marks where lines, sentences and paragraphs end; a passage is hashed only if it has
as many words as a known text, which no other passage can equal.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import col, whole_text, written
from tidemark.llm.license_texts import KNOWN, PUBLISHED, SPELLINGS

#: A line that names who holds the copyright.
COPYRIGHT_LINE = r"(?im)^[ \t*#/;-]*(?:copyright[ \t]+(?:\(c\)|©|[0-9])|\(c\)[ \t]*[0-9]|©)[^\n]*$"
#: Widest first; a text that is found in more than one is reported as the widest.
SCOPES = ("document", "paragraph", "line", "sentence")
#: A run of paragraphs; between the document and one paragraph.
RUN = "paragraphs"
RANKED = (SCOPES[0], RUN, *SCOPES[1:])
SENTENCE_END, PARAGRAPH_END = r"([.!?])[ \t]+", r"\n[ \t\r]*\n\s*"
#: So many known texts (below 10 MB of digests) are broadcast; more are joined by exchange.
BROADCAST_TEXTS = 100_000

_COPYRIGHT, _SENTENCE, _PARAGRAPH = re.compile(COPYRIGHT_LINE), re.compile(SENTENCE_END), re.compile(PARAGRAPH_END)
#: A word, the end of a line or paragraph (a character that no text has after `lowered`), the end of a sentence.
_BREAK = "\ue001"
_TOKEN = re.compile(rf"[^\W_]+|[\n{_BREAK}]|[.!?](?=[ \t])")
_MARKS = frozenset(("\n", _BREAK, ".", "!", "?"))


def known_licenses(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([*KNOWN, *PUBLISHED], "license string, text string")


def lowered(text: str) -> str:
    text = text.lower()
    return text.replace(_BREAK, " ") if _BREAK in text else text


def spelled(text: str) -> str:
    for found, read in SPELLINGS:
        if found in text:
            text = text.replace(found, read)
    return text


def split_words(text: str) -> tuple[list[str], list[int], list[str]]:
    """The canonical words of a lower-case text, and before which word a mark stands, with the mark."""
    tokens = _TOKEN.findall(_PARAGRAPH.sub(_BREAK, spelled(text)))
    at = [i for i, t in enumerate(tokens) if t in _MARKS]
    marks = [tokens[i] for i in at]
    return [t for t in tokens if t not in _MARKS] if at else tokens, [i - k for k, i in enumerate(at)], marks


def ranges(n: int, cuts: list[int], marks: list[str], at: frozenset[str]) -> list[tuple[int, int]]:
    """The stretches of words between the marks of some kinds, without empty ones."""
    edges = [0, *(c for c, m in zip(cuts, marks) if m in at), n]
    return [(a, b) for a, b in zip(edges, edges[1:]) if a < b]


def digest(words: list[str]) -> bytes:
    return sha256(" ".join(words).encode("utf-8", "surrogatepass")).digest()


def passages(text: str, lengths: frozenset[int], runs: dict[int, list[int]]) -> dict[bytes, int]:
    """Digest to least rank of the passages that have one of `lengths` words, and of the runs of paragraphs whose first has
    n words and that have one of `runs[n]` words in all."""
    text = lowered(text)
    plain = "copyright" not in text and "(c)" not in text and "©" not in text
    words, cuts, marks = split_words(text if plain else _COPYRIGHT.sub("", text))
    found: dict[bytes, int] = {}

    def note(own: list[str], a: int, b: int, rank: int) -> None:
        key = digest(own[a:b])
        found[key] = min(rank, found.get(key, rank))

    if len(words) in lengths and words:
        note(words, 0, len(words), 0)
    whole = ranges(len(words), cuts, marks, frozenset((_BREAK,)))
    ends = {b for _, b in whole}
    for a, b in whole:
        for n in runs.get(b - a, ()):
            if a + n in ends:
                note(words, a, a + n, 1)
    for rank, at in ((2, frozenset((_BREAK,))), (3, frozenset((_BREAK, "\n")))):
        for a, b in ranges(len(words), cuts, marks, at):
            if b - a in lengths:
                note(words, a, b, rank)
    if not plain:  # a sentence may be a copyright line of its own, or stand in one
        words, cuts, marks = split_words(_COPYRIGHT.sub("", _SENTENCE.sub(r"\1\n", text)))
    for a, b in ranges(len(words), cuts, marks, _MARKS):
        if b - a in lengths:
            note(words, a, b, 4)
    return found


def known_forms(known: DataFrame) -> DataFrame:
    """(license, run, n, first, digest): a row for each known text, and one more if it has several paragraphs, with the
    number of words in all and in the first paragraph."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words, cuts, marks = split_words(_COPYRIGHT.sub("", lowered(text)))
                parts = ranges(len(words), cuts, marks, frozenset((_BREAK,)))
                if words:
                    rows.append((name, False, len(words), 0, digest(words)))
                if len(parts) > 1:
                    rows.append((name, True, len(words), parts[0][1] - parts[0][0], digest(words)))
            kinds = (pa.string(), pa.bool_(), pa.int32(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["license", "run", "n", "first", "digest"])

    listed = known.select(col("license").cast("string").alias("license"), whole_text(col("text")).alias("text"))
    return listed.mapInArrow(run, "license string, run boolean, n int, first int, digest binary")


def find_licenses(
    docs: DataFrame, known: DataFrame | None = None, doc_id: str = "doc_id", text: str = "text", broadcast_texts: int = BROADCAST_TEXTS
) -> DataFrame:
    """doc_id, license, scope: the known licences that a document is, or holds as an entire passage.

    One row for each distinct pair of id and licence, with the widest scope: document, run of paragraphs, paragraph, line,
    sentence; equal scopes are one. `known` has columns license and text (KNOWN and PUBLISHED by default); texts without
    letters or digits and null ones in it are left out. Null and empty documents hold nothing; null ids are reported as
    null. Texts of any length are read whole, in time that grows with their length and with what they hold as long as a
    known text. Empty tables give no rows. Repeated rows count once. Extra columns are ignored, whatever their names.
    """
    forms = written(known_forms(known_licenses(docs.sparkSession) if known is None else known), "license_digests")
    # Different numbers of words, not texts: no more than the longest known text has words.
    sizes = forms.groupBy("run", "n", "first").agg(F.count("*").alias("texts")).collect()
    lengths, runs = frozenset(r["n"] for r in sizes if not r["run"]), {}
    for r in sizes:
        if r["run"]:
            runs.setdefault(r["first"], []).append(r["n"])
    few = sum(r["texts"] for r in sizes) <= broadcast_texts
    some = docs.select(col(doc_id).alias("doc_id"), whole_text(col(text)).alias("text"))
    kind = some.schema["doc_id"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, ranks, digests = [], [], []
            for i, one in enumerate(batch.column("text")):
                for key, rank in passages(one.as_py(), lengths, runs).items():
                    ids.append(i)
                    ranks.append(rank)
                    digests.append(key)
            own = batch.column("doc_id").take(pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([own, pa.array(ranks, pa.int32()), pa.array(digests, pa.binary())], ["doc_id", "rank", "digest"])

    hashed = some.mapInArrow(scan, f"doc_id {kind}, rank int, digest binary")
    digests = forms.select("license", (F.col("run")).alias("run"), "digest").distinct()
    met = hashed.join(F.broadcast(digests) if few else digests.hint("merge"), "digest").filter((F.col("rank") == 1) == F.col("run"))
    widest = met.groupBy("doc_id", "license").agg(F.min("rank").alias("rank"))
    return widest.select("doc_id", "license", F.element_at(F.array(*map(F.lit, RANKED)), F.col("rank") + 1).alias("scope"))
