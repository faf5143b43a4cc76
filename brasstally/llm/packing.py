"""Packing token sequences: first-fit decreasing over a tournament tree, in randomised groups.

Texts become token ids where they lie. A document is cut into full sequences and one
rest; only the rests need packing. They are dealt at random into groups of about
``group_rows``, and each group packs its rests by decreasing length, each into the
first sequence with room. A tournament tree over the sequences' free room finds that
one in a logarithm of steps.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brasstally.llm.common import table, tasks, written

CAPACITY = 2048
GROUP_ROWS = 4096
END_ID = 1
PIECES = "doc_id {}, start long, length long, ids_crc32 long, doc_tokens long{}"


def word_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_letters() -> list[str]:
    """The character that byte-level vocabularies write for each byte: printable ones stand for themselves."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in own}
    for b in range(256):
        letters.setdefault(b, chr(256 + sum(x not in own for x in range(b))))
    return [letters[b] for b in range(256)]


class WordIds:
    """Token ids of whole texts, by remembering the ids of words between ASCII white space.

    The vocabulary's tokens never hold white space, its clean-up neither moves nor
    joins characters across it, and so a text's ids are those of its words in turn.
    Two generations of remembered words bound the memory: when the younger is full,
    it becomes the older one, and words met again move over.
    """

    #: Below this character, lower case and the composed form follow from the character alone.
    SIMPLE = "\u0130"

    def __init__(self, path: str, remember: int = 300_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.letters = self.tokenizer.model, byte_letters()
        self.remember, self.known, self.older, self.bodies = remember, {}, {}, {}

    def encode(self, word: str) -> bytes:
        if word.isalpha() and max(word) < self.SIMPLE:  # one word for the vocabulary, in its final form
            spelt = word if word.isascii() else "".join([self.letters[b] for b in word.encode()])
            ids = [t.id for t in self.model.tokenize(spelt)]
        else:
            ids = self.tokenizer.encode(word, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def body(self, word: str) -> bytes:
        if (found := self.bodies.get(word)) is None:
            if len(self.bodies) >= self.remember:
                self.bodies = {}
            found = self.bodies[word] = self.encode(word)
        return found

    def learn(self, raw: bytes) -> bytes:
        """A word's ids; case and a final stop or comma are taken off first where they stand alone."""
        word, rest = raw.decode(), b""
        if len(word) > 1 and word[-1] in ".," and word[-2].isalpha() and word[-2] < self.SIMPLE:
            word, rest = word[:-1], self.body(word[-1])
        lower = word.lower() if word.isalpha() and max(word) < self.SIMPLE else word
        return self.body(lower) + rest

    def ids(self, text: str) -> bytes:
        """The ids as little-endian 32-bit numbers."""
        words = text.encode().split()
        new = set(words).difference(self.known)
        if new and len(self.known) + len(new) > self.remember:
            self.older, self.known = self.known, {}
            new = set(words)
        for w in new:
            self.known[w] = self.older.get(w) or self.learn(w)
        return b"".join(map(self.known.__getitem__, words))


def cut(path: str, capacity: int, with_ids: bool, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordIds(path)
        end = struct.pack("<I", END_ID)
        for batch in batches:
            ids, rows = batch.column(0).to_pylist(), []
            for doc_id, text in zip(ids, batch.column(1), strict=True):
                tokens = words.ids(text.as_py() or "") + end
                n = len(tokens) // 4
                for start in range(0, n, capacity):
                    piece = tokens[4 * start : 4 * (start + capacity)]
                    row = [doc_id, start, len(piece) // 4, zlib.crc32(piece), n]
                    rows.append([*row, struct.unpack(f"<{len(piece) // 4}I", piece)] if with_ids else row)
                if len(rows) >= 4096:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return run


def first_fit_decreasing(lengths: list[int], capacity: int) -> tuple[list[int], list[int], int]:
    """For lengths in decreasing order: each one's bin and offset, and the number of bins."""
    leaves = 1
    while leaves < len(lengths):
        leaves *= 2
    room = [capacity] * (2 * leaves)  # room[k] is the larger room of its two children
    bins, offsets, used = [], [], 0
    for n in lengths:
        k = 1
        while k < leaves:
            k *= 2
            if room[k] < n:
                k += 1
        bins.append(k - leaves)
        offsets.append(capacity - room[k])
        used = max(used, k - leaves + 1)
        room[k] -= n
        while k > 1:
            k //= 2
            most = max(room[2 * k], room[2 * k + 1])
            if room[k] == most:
                break
            room[k] = most
    return bins, offsets, used


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str | None = None,
    capacity: int = CAPACITY,
    group_rows: int = GROUP_ROWS,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: the id, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``.

    With ``with_ids`` also the piece's token ``ids``. A null or empty text is one piece
    that holds the end id alone. Repeated rows and null ids are packed like others.
    Other columns are left out; an empty table gives no pieces.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    ddl = PIECES.format(kind, ", ids array<long>" if with_ids else "")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(ddl))
    pieces = written(rows.mapInArrow(cut(path or word_vocabulary(), capacity, with_ids, arrow), ddl), "pieces")
    rest = pieces.where(F.col("length") < capacity).count()
    groups = max(1, -(-rest // group_rows))
    # The table is written, so that a row's place in it is the same on every attempt.
    place = F.xxhash64("doc_id", "start", "ids_crc32", F.monotonically_increasing_id())
    dealt = pieces.withColumn("group", F.pmod(place, F.lit(groups)))

    def fill(key, pdf):
        import numpy as np

        pdf = pdf.sort_values(["length", "ids_crc32", "start", "doc_id"], ascending=[False, True, True, True])
        lengths = pdf["length"].tolist()
        full = int((pdf["length"] == capacity).sum())
        bins, offsets, used = first_fit_decreasing(lengths[full:], capacity)
        base = int(key[0]) << 32
        pdf["sequence_id"] = np.array([*range(used, used + full), *bins], dtype="int64") + base
        pdf["offset"] = np.array([0] * full + offsets, dtype="int64")
        return pdf.drop(columns="group")

    out = ddl + ", sequence_id long, offset long"
    return dealt.repartition(tasks(spark), "group").groupBy("group").applyInPandas(fill, out)


def op8_packing(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
