"""Language identification by segmentation-marginalised unigrams.

Each language gives every piece of a fixed public vocabulary a probability. A word's
probability is the sum over all ways to segment it into pieces, found by a forward
pass; a text's is the product over its words. The piece probabilities come from
expectation maximisation over word counts: a forward-backward pass gives the expected
number of times that each piece is used.

Fitting reads a sample of about ``rows_per_language`` labelled rows of each language,
chosen by a hash of their ids; whole texts are counted. Prediction reads every whole
text, and nothing but the text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brasstally.llm.common import table, written

ROWS_PER_LANGUAGE = 1500
ROUNDS = 3
#: Probability of a character that no piece covers, the same in every language.
UNSEEN = 1e-7
UNKNOWN = "und"
WORD = re.compile(r"[^\W\d_]+")
#: Characters that are split into words at a time.
BLOCK = 1 << 21


def public_pieces(path: str | None = None) -> list[str]:
    """Lower-case letter pieces of a sentencepiece vocabulary; ``▁`` begins a word."""
    import sentencepiece

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {model.id_to_piece(i) for i in range(model.get_piece_size())}
    return sorted(p for p in pieces if p == p.lower() and p != "▁" and WORD.fullmatch(p.removeprefix("▁")))


class Lattice:
    """The pieces of words, and passes over all their segmentations.

    ``probs`` has a row for each piece and a column for each language; its last row
    is for a character that no piece covers.
    """

    def __init__(self, pieces: list[str]):
        self.index = {p: i for i, p in enumerate(pieces)}
        #: Every beginning of a piece, with the piece's number where it is one, else -1.
        self.begins = {p[:k]: -1 for p in pieces for k in range(1, len(p) + 1)} | self.index
        self.unseen = len(pieces)
        self.longest = max(map(len, pieces))

    def arcs(self, word: str) -> list[list[tuple[int, int]]]:
        """For each place in ``▁word``: the (start, piece) of the pieces that end there."""
        text = "▁" + word
        n = len(text)
        ends: list[list[tuple[int, int]]] = [[] for _ in range(n + 1)]
        for i in range(n):
            for j in range(i + 1, n + 1):
                part = text[i:j]
                if part not in self.begins:
                    break
                if (k := self.index.get(part)) is not None:
                    ends[j].append((i, k))
            if text[i] not in self.index:
                ends[i + 1].append((i, self.unseen))
        return ends

    def score(self, words: list[str], probs: np.ndarray) -> np.ndarray:
        """Log probability of each word in each language, summed over its segmentations.

        Words of one length go forward together, a place at a time.
        """
        out = np.empty((len(words), probs.shape[1]))
        with_none = np.vstack([probs, np.zeros(probs.shape[1])])  # the last row stands for "no such piece"
        lengths: dict[int, list[int]] = {}
        for k, word in enumerate(words):
            lengths.setdefault(len(word), []).append(k)
        for n, places in lengths.items():
            for at in range(0, len(places), max(1, 40_000 // (n + 1))):
                some = places[at : at + max(1, 40_000 // (n + 1))]
                out[some] = self.forward([words[k] for k in some], n + 1, with_none)
        return out

    def forward(self, words: list[str], n: int, probs: np.ndarray) -> np.ndarray:
        """The same for words of one length; ``n`` counts the mark before them."""
        none, reach, wide, get = len(probs) - 1, min(n, self.longest), len(words), self.begins.get
        flat, found = [], []  # at j, d, w: the piece of word w that ends at place j and began d places before
        for w, word in enumerate(words):
            text = "▁" + word
            for i in range(n):
                for j in range(i + 1, n + 1):
                    if (k := get(text[i:j])) is None:
                        break
                    if k >= 0:
                        flat.append((j * reach + j - i) * wide + w)
                        found.append(k)
                if text[i] not in self.index:
                    flat.append(((i + 1) * reach + 1) * wide + w)
                    found.append(self.unseen)
        pieces = np.full((n + 2) * reach * wide, none, dtype=np.int32)
        pieces[flat] = found
        pieces = pieces[wide:].reshape(-1, wide)  # row j * reach + d - 1
        forward = np.zeros((n + 1, wide, probs.shape[1]))
        forward[0] = 1.0
        logs = np.zeros(forward.shape[1:])
        for j in range(1, n + 1):
            for d in range(1, min(j, reach) + 1):
                row = pieces[j * reach + d - 1]
                used = np.nonzero(row != none)[0]
                if len(used):
                    forward[j, used] += forward[j - d, used] * probs[row[used]]
            if j % 16 == 0:  # keep long words within the range of doubles
                most = forward[j]
                logs += np.log(most)
                first = max(0, j - reach)
                forward[first : j + 1] = forward[first : j + 1] / most
        return np.log(forward[n]) + logs

    def expected(self, word: str, column: list[float], n: float, into: dict[int, float]) -> None:
        """Add the expected uses of each piece over ``n`` occurrences of a word of moderate length."""
        ends = self.arcs(word)
        forward = [1.0] + [0.0] * (len(ends) - 1)
        for j in range(1, len(ends)):
            forward[j] = sum(forward[i] * column[p] for i, p in ends[j])
        backward = [0.0] * (len(ends) - 1) + [1.0]
        for j in range(len(ends) - 1, 0, -1):
            for i, p in ends[j]:
                weight = backward[j] * column[p]
                backward[i] += weight
                if p != self.unseen:
                    into[p] = into.get(p, 0.0) + n * forward[i] * weight / forward[-1]


def fit(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    id_col: str = "doc_id",
    rows_per_language: int = ROWS_PER_LANGUAGE,
    rounds: int = ROUNDS,
    path: str | None = None,
) -> tuple[list[str], list[str], np.ndarray]:
    """Languages, pieces and piece probabilities, from rows whose text and language are not null.

    Rows with a null id are left out of fitting. What reaches the driver is a number
    for each piece and language, of either size bounded by vocabulary and labels.
    """
    rows = docs.select(
        docs[lang_col].cast("string").alias("lang"), docs[text_col].cast("string").alias("text"), docs[id_col].alias("id")
    ).where("lang is not null and text is not null and id is not null")
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    pieces = public_pieces(path)
    languages = sorted(sizes)
    if not languages:
        return [], pieces, np.zeros((len(pieces) + 1, 0))
    place = F.pmod(F.xxhash64("id"), F.lit(1_000_000))
    share = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, rows_per_language / n))])
    words = F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)")))
    counts = written(
        rows.where(place < share[F.col("lang")] * 1_000_000)
        .select("lang", words.alias("word"))
        .where(F.length("word") <= 48)  # longer ones teach no more of the pieces, which are shorter
        .groupBy("lang", "word")
        .count(),
        "words",
    )
    lattice = Lattice(pieces)
    probs = np.full((len(pieces) + 1, len(languages)), 1.0 / len(pieces))
    probs[-1] = UNSEEN
    columns = {name: k for k, name in enumerate(languages)}
    for _ in range(rounds):
        now = [probs[:, k].tolist() for k in range(len(languages))]

        def step(batches, now=now):
            used: dict[int, dict[int, float]] = {}
            for pdf in batches:
                for name, word, n in zip(pdf["lang"], pdf["word"], pdf["count"], strict=True):
                    k = columns[name]
                    lattice.expected(word, now[k], n, used.setdefault(k, {}))
            import pandas as pd

            for k, uses in used.items():
                yield pd.DataFrame({"lang": k, "piece": list(uses), "uses": list(uses.values())})

        uses = counts.mapInPandas(step, "lang int, piece int, uses double").groupBy("lang", "piece").agg(F.sum("uses").alias("uses"))
        total = np.full((len(pieces), len(languages)), 0.01)
        for k, p, n in uses.collect():
            total[p, k] += n
        probs[:-1] = total / total.sum(axis=0)
    return languages, pieces, probs


def blocks(text: str) -> Iterator[list[str]]:
    """The words of a text, at most about a megabyte's at a time."""
    at = 0
    while at < len(text):
        end = at + BLOCK
        while end < len(text) and not text[end].isspace():
            end += 1
        yield WORD.findall(text[at:end])
        at = end


class Scorer:
    """Scores of whole texts; words met before are remembered, up to a bound."""

    def __init__(self, pieces: list[str], probs: np.ndarray, remember: int = 400_000):
        self.lattice, self.probs = Lattice(pieces), probs
        self.remember, self.known = remember, {}
        self.table = np.empty((remember, probs.shape[1]))

    def totals(self, parts: list[list[str]]) -> list[np.ndarray]:
        """The summed score of each list of words."""
        every = set().union(*parts)
        new = [w for w in every if w not in self.known]
        if len(self.known) + len(new) > self.remember:
            self.known, new = {}, list(every)
        if len(new) > self.remember:
            self.remember = len(new)
            self.table = np.empty((self.remember, self.probs.shape[1]))
        self.table[len(self.known) : len(self.known) + len(new)] = self.lattice.score(new, self.probs)
        self.known |= {w: k for k, w in enumerate(new, len(self.known))}
        return [self.table[list(map(self.known.__getitem__, p))].sum(axis=0) for p in parts]

    def texts(self, texts: list[str | None]) -> list[np.ndarray | None]:
        """Scores by language, or None for a text without a letter; about ``BLOCK`` characters at a time."""
        out: list[np.ndarray | None] = [None] * len(texts)
        parts, owners, held = [], [], 0

        def close():
            for k, score in zip(owners, self.totals(parts), strict=True):
                out[k] = score if out[k] is None else out[k] + score
            parts.clear()
            owners.clear()

        for k, text in enumerate(texts):
            for words in blocks((text or "").lower()):
                if words:
                    parts.append(words)
                    owners.append(k)
                    held += sum(map(len, words))
                if held > BLOCK:
                    close()
                    held = 0
        if parts:
            close()
        return out


def predict(docs: DataFrame, model: tuple[list[str], list[str], np.ndarray], text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` with ``lang_pred`` and ``score`` (the likeliest language's share, 0 to 1).

    ``und`` with score 0 where the text is null, empty or without a letter, and
    everywhere if nothing could be learned. Columns of these names are replaced.
    """
    languages, pieces, probs = model
    held = docs.sparkSession.sparkContext.broadcast((pieces, probs))
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    rows = docs.select(*[docs[f"`{c}`"] for c in kept])
    at = kept.index(text_col)
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = rows.withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)}).schema
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*held.value)
        for batch in batches:
            names, scores = [], []
            texts = batch.column(at).to_pylist()
            for logs in scorer.texts(texts) if languages else [None] * len(texts):
                if logs is None:
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                best = int(logs.argmax())
                names.append(languages[best])
                scores.append(round(1 / float(np.exp(logs - logs[best]).sum()), 6))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names), pa.array(scores, pa.float64())], schema=arrow)

    return rows.mapInArrow(run, schema)


def held_out(id_col: str):
    """Rows of which nothing is learned; a null id is not one of them, but teaches nothing either."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred``, ``score`` of every row, learned from the rows not held out."""
    model = fit(docs.where(~held_out("doc_id")))
    return predict(docs.select("doc_id", "text"), model).select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


def with_letter(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of which ``predict`` would find a word in the text."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([WORD.search((t.as_py() or "").lower()) is not None for t in batch.column(at)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def keep_identified(docs: DataFrame) -> DataFrame:
    """The documents whose language can be told, with all their columns: only texts without a letter go.

    Where no row teaches a language, every text with a letter stays.
    """
    model = fit(docs.where(~held_out("doc_id")))
    marked = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), docs["text"].cast("string").alias("text"))
    if not model[0]:
        return with_letter(marked).select("row.*")
    return predict(marked, model).where(F.col("lang_pred") != UNKNOWN).select("row.*")


def op7_language_id(spark, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))
