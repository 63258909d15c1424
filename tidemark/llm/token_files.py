"""Token ids as flat unsigned integer files with 64-bit document offsets.

A token set is a folder of shards in ascending doc_id order. A shard is two flat little-endian files:

- `<name>.ids`: the ids of its documents one after another, uint16 where the vocabulary allows it, else uint32;
- `<name>.idx`: three int64 for each document: doc_id (NO_ID for null), the place of its first id
  counted over the whole set, and its number of ids.

`manifest` (Parquet) names the shards in order with their sizes and bases. A base is the sum of the sizes of the
shards before it, so any document is found by its offset, and the concatenated `.ids` files are one flat array.
"""

from __future__ import annotations

import os
import uuid
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import batches_of, col, whole_text, written

NO_ID = -(2**63)
#: Bytes of text that are encoded at a time, unless one document alone is longer.
BLOCK = 4_000_000
#: Different words a worker remembers the ids of; beyond it the memory starts anew.
REMEMBERED = 400_000
#: Marks that are cut from the end of a word.
MARKS = ".,!?;:*%$&#|"


def storage(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 2**16 else "<u4"


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """The store behind a path or URI, local or not."""
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


class WordEncoder:
    """Encodes whole texts with a tokenizer whose tokens never span white space.

    Such a tokenizer gives a text the ids of its words one after another, so each different word is encoded once for as
    long as it is remembered, and the words of a block of texts are numbered by Arrow. New words are further cut where marks
    end them, A-Z is lower-cased for a tokenizer that does so, and words of a-z go to the tokenizer's model without its
    normaliser, where a probe shows that none of this changes the ids. `white_space_apart` says whether a tokenizer is of
    that kind; texts are encoded whole if it is not.
    """

    def __init__(self, path: str, end: int | None):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.apart = white_space_apart(self.tokenizer)
        # Special tokens keep their case: a block that may hold one is left as it is.
        self.special = os.path.commonprefix([x.content for x in self.tokenizer.get_added_tokens_decoder().values()])
        self.folds = self.apart and bool(self.special) and self._ids(["Word", "A"]) == self._ids(["word", "a"])
        self.marks = MARKS if self.apart and self._ids(["ab,.", "a1!"]) == self._ids(["ab", ",.", "a1", "!"]) else ""
        self.model = self.tokenizer.model if self.apart else None
        letters = [w for w in (t.removesuffix("</w>") for t in self.tokenizer.get_vocab()) if is_plain(w)]
        probe = sorted(letters)[:: max(1, len(letters) // 400)]
        probe += [a + b for a, b in zip(probe, probe[1:])]
        self.plain = self.apart and self._of_model(probe) == [x.ids for x in self.tokenizer.encode_batch(probe, add_special_tokens=False)]
        self.end = [] if end is None else [end]
        self.forget()

    def _ids(self, texts: list[str]) -> list[int]:
        return [i for x in self.tokenizer.encode_batch(texts, add_special_tokens=False) for i in x.ids]

    def _of_model(self, words: list[str]) -> list[list[int]]:
        tokenize = self.model.tokenize
        return [[t.id for t in tokenize(w)] for w in words]

    def forget(self) -> None:
        """Drop what is remembered; a worker that waits for its next task holds the tokenizer alone."""
        self.known: dict[str, int] = {}
        self.ids, self.ends = array("I"), array("q", [0])
        self.number("\n", self.end)  # the number 0 ends a document
        self.number("", [])

    def number(self, word: str, ids) -> None:
        self.known[word] = len(self.ends) - 1
        self.ids.extend(ids)
        self.ends.append(len(self.ids))

    def parts(self, word: str) -> tuple[str, str]:
        """The front of a word and the marks that end it."""
        front = word.rstrip(self.marks) if self.marks else word
        tail = word[len(front) :]
        if tail and not (front and front[-1].isalnum()):
            front, tail = word, ""
        return front, tail

    def learn(self, words: list[str]) -> None:
        """Number words that are not known, and the parts that their ids are made of."""
        known, ids, ends = self.known, self.ids, self.ends
        pairs = [self.parts(w) for w in words]
        missing = [p for p in dict.fromkeys(p for pair in pairs for p in pair) if p not in known]
        plain = [w for w in missing if is_plain(w)] if self.plain else []
        for word, found in zip(plain, self._of_model(plain)):
            self.number(word, found)
        rest = [w for w in missing if w not in known] if plain else missing
        for word, x in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False), strict=True):
            self.number(word, x.ids)
        for word, (front, tail) in zip(words, pairs, strict=True):
            if tail:
                a, b = known[front], known[tail]
                self.number(word, ids[ends[a] : ends[a + 1]] + ids[ends[b] : ends[b + 1]])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, each with the end id, and the number of ids of each text."""
        if not self.apart:
            found = [x.ids + self.end for x in self.tokenizer.encode_batch(texts.to_pylist(), add_special_tokens=False)]
            return np.array([i for ids in found for i in ids], "<u4"), np.array([len(x) for x in found], "i8")
        if self.folds and not pc.any(pc.match_substring(texts, self.special)).as_py():
            texts = pc.ascii_lower(texts)
        words = pc.ascii_split_whitespace(texts)
        cuts = words.offsets.to_numpy().astype("i8") - words.offsets[0].as_py()
        coded = words.flatten().dictionary_encode()
        if len(self.known) > REMEMBERED:
            self.forget()
        listed = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.known.get, listed))
        strange = [i for i, n in enumerate(found) if n is None]
        if strange:
            self.learn([listed[i] for i in strange])
            for i in strange:
                found[i] = self.known[listed[i]]
        flat = np.frombuffer(self.ids, "u4") if self.ids else np.zeros(0, "u4")
        starts = np.frombuffer(self.ends, "i8").astype("i4")  # what is remembered is small
        parts = np.array(found, "i4")[coded.indices.to_numpy(zero_copy_only=False)]
        parts = np.insert(parts, cuts[1:], 0)
        sizes = np.diff(starts)[parts]
        last = np.cumsum(sizes)
        total = int(last[-1]) if len(last) else 0
        at = np.repeat((starts[parts] - (last - sizes)).astype("i4"), sizes) + np.arange(total, dtype="i4")
        text_ends = cuts[1:] + np.arange(len(texts))
        counts = np.diff(np.concatenate(([0], last[text_ends])))
        return flat[at], counts


def is_plain(word: str) -> bool:
    return word.isascii() and word.isalpha() and word.islower()


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, pa.Array]]:
    """Ids (NO_ID for null) and texts in pieces of about BLOCK bytes, or one text that is longer."""
    for batch in batches:
        numbers = pc.fill_null(batch.column(0), NO_ID).to_numpy(zero_copy_only=False)
        texts = batch.column(1)
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype("i8"))
        at = 0
        while at < len(numbers):
            end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BLOCK)))
            yield numbers[at:end], texts.slice(at, end - at)
            at = end


@lru_cache(maxsize=2)
def worker_encoder(path: str, end: int | None) -> WordEncoder:
    """One encoder for all tasks of a worker."""
    return WordEncoder(path, end)


def white_space_apart(tokenizer) -> bool:
    """Whether white space only separates: a probe with words, marks and spaces is encoded both ways."""
    probe = "It's  a\ttest,\n 12 é—ß\r\nx ' ' ..! ́a <b> don't"
    whole = tokenizer.encode(probe, add_special_tokens=False).ids
    parts = [tokenizer.encode(w, add_special_tokens=False).ids for w in probe.split()]
    return whole == [i for p in parts for i in p]


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end: int | None = 1,
    doc_id: str = "doc_id",
    text: str = "text",
    vocabulary: int | None = None,
) -> DataFrame:
    """Encode `docs` into the token set `folder` (a new path that all executors reach); returns its manifest.

    The table is sorted by doc_id over all partitions, null ids first, equal ids by a hash of their text. Each
    task encodes its range into a shard under a name of its own and streams it to the store. A task that fails
    or is run twice leaves a shard that no manifest names. The bases come from prefix sums over the shards'
    sizes; a second pass writes the offsets. Null texts count as empty and have the `end` id only (with
    end=None nothing). Repeated rows are written as often as they come. An empty table gives an empty manifest.
    Extra columns are ignored.

    `tokenizer` is a tokenizer file that exists on every machine, `vocabulary` its number of ids.
    """
    if vocabulary is None:
        from tokenizers import Tokenizer

        vocabulary = max(Tokenizer.from_file(tokenizer).get_vocab_size(), (end or 0) + 1)
    kind = storage(vocabulary)
    rows = docs.select(col(doc_id).cast("long").alias("doc_id"), whole_text(col(text)).alias("text"))
    # By the hash of the text too, so that null or equal ids are divided.
    rows = rows.withColumn("spread", F.xxhash64("text"))
    placed = rows.repartitionByRange("doc_id", "spread").sortWithinPartitions("doc_id", "spread").drop("spread")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(tokenizer, end)
        store, root = open_folder(folder)
        name = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        docs = tokens = 0
        ids_out = lens_out = None
        try:
            for numbers, texts in blocks(batches):
                if ids_out is None:
                    store.create_dir(root, recursive=True)
                    ids_out, lens_out = (store.open_output_stream(f"{root}/{name}.{x}") for x in ("ids", "len"))
                ids, counts = encoder.encode(texts)
                if vocabulary <= int(ids.max(initial=0)):
                    raise ValueError(f"id {ids.max()} is outside a vocabulary of {vocabulary}")
                ids_out.write(ids.astype(kind).tobytes())
                lens_out.write(np.column_stack((numbers, counts)).astype("<i8").tobytes())
                docs, tokens = docs + len(counts), tokens + len(ids)
        finally:
            encoder.forget()
        if ids_out is not None:
            ids_out.close()
            lens_out.close()
            yield pa.RecordBatch.from_pydict({"shard": [name], "docs": [docs], "tokens": [tokens]})

    shards = written(placed.mapInArrow(encode, "shard string, docs long, tokens long"), "token_shards")
    # A row for each shard: the window is as small as the number of tasks.
    before = Window.partitionBy(F.lit(1)).orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    based = shards.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
    based = written(based.withColumn("kind", F.lit(kind)), "token_bases")

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_folder(folder)
        for batch in batches:
            for name, base in zip(batch.column("shard").to_pylist(), batch.column("base").to_pylist(), strict=True):
                with store.open_input_stream(f"{root}/{name}.len") as source:
                    with store.open_output_stream(f"{root}/{name}.idx") as out:
                        at = base
                        while block := source.read(16 * 65_536):
                            pairs = np.frombuffer(block, "<i8").reshape(-1, 2)
                            starts = at + np.concatenate(([0], np.cumsum(pairs[:, 1])[:-1]))
                            out.write(np.column_stack((pairs[:, 0], starts, pairs[:, 1])).astype("<i8").tobytes())
                            at += int(pairs[:, 1].sum())
            yield batch

    one_each(based).mapInArrow(index, based.schema).write.parquet(f"{folder}/manifest")
    return docs.sparkSession.read.schema(based.schema).parquet(f"{folder}/manifest")


def read_token_files(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """Read a token set back: doc_id, start, n_tokens, ids_crc32 (of the ids as uint32), and `ids` if asked for.

    A task maps the two files of its shards into memory where the store is local, and else reads them in
    blocks of documents; it never holds a whole shard.
    """
    schema = "shard string, docs long, tokens long, base long, kind string"
    manifest = spark.read.schema(schema).parquet(f"{folder}/manifest")
    out = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_folder(folder)
        for shard in (r for b in batches for r in b.to_pylist()):
            item = np.dtype(shard["kind"]).itemsize
            path = f"{root}/{shard['shard']}"
            local = isinstance(store, fs.LocalFileSystem) and os.path.getsize(f"{path}.ids") > 0
            with store.open_input_stream(f"{path}.idx") as index, store.open_input_file(f"{path}.ids") as file:
                flat = np.memmap(f"{path}.ids", shard["kind"], "r") if local else None
                while block := index.read(24 * 4_096):
                    entries = np.frombuffer(block, "<i8").reshape(-1, 3)
                    made: dict[str, list] = {k: [] for k in ("doc_id", "start", "n_tokens", "ids_crc32")}
                    held = []
                    for number, start, n in entries.tolist():
                        at = start - shard["base"]
                        if flat is not None:
                            ids = flat[at : at + n]
                        else:
                            file.seek(at * item)
                            ids = np.frombuffer(file.read(n * item), shard["kind"])
                        made["doc_id"].append(None if number == NO_ID else number)
                        made["start"].append(start)
                        made["n_tokens"].append(n)
                        made["ids_crc32"].append(zlib.crc32(ids.astype("<u4").tobytes()))
                        if with_ids:
                            held.append(ids.astype("i8"))
                    if not with_ids:
                        yield _batch(made)
                        continue
                    first = 0
                    for part in batches_of(iter(held), len, BLOCK):
                        last = first + len(part)
                        yield _batch({k: v[first:last] for k, v in made.items()}, part)
                        first = last

    return one_each(manifest).mapInArrow(read, out)


def one_each(manifest: DataFrame) -> DataFrame:
    """About a shard for each task; a number given by hand keeps the small rows from being merged into few tasks."""
    return manifest.repartitionByRange(max(1, manifest.count()), "shard")


def _batch(made: dict[str, list], ids: list | None = None) -> pa.RecordBatch:
    columns = [pa.array(made[k], pa.int64()) for k in ("doc_id", "start", "n_tokens", "ids_crc32")]
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
    if ids is not None:
        columns, names = [*columns, pa.array(ids, pa.list_(pa.int64()))], [*names, "ids"]
    return pa.RecordBatch.from_arrays(columns, names)
