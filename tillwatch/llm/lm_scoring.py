"""Cross-entropy difference between two matched bigram models.

The target model is estimated on the texts that the data should resemble, the background model on the whole
corpus. Both share one vocabulary, all words of the corpus, and one smoothing, so that their losses per token
can be subtracted. A document's score is the mean difference over its tokens; low is close to the target.

Every word and every bigram counts. A token's loss has two parts: one of its bigram, log(n(v, w) + prior p(w)),
and one of the word before it, log(n(v) + prior). For the most frequent words and bigrams, lists of a
documented size, counts are broadcast and the parts are summed where the text is read. All other tokens are
dealt out by their word: the rows of a word hold all its counts, as a word, before a word and
in both models, so losses are computed right there, without a join, and added up per text. The lists
change no score. They bound what meets in one task: a word beyond them is rarer than all on the list.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwatch.llm.cells import whole_cells
from tillwatch.llm.common import slices, stored

#: Bytes of text whose words are numbered together.
AT_ONCE = 4 << 20
#: Marks of a row: of the target, of a frequent word, the sums of a text. They share a number with its counts.
AIM, KNOWN, WHOLE = 1, 2, 4
MARKS, LAST, COUNT = 7, 3, 24


@dataclass(frozen=True)
class Bigrams:
    """``add``: added to each unigram count; ``prior``: weight of the unigram model in a bigram's probability;
    ``words``, ``bigrams``: how many of the most frequent ones are broadcast (some 60 and 30 bytes each)."""

    add: float = 0.5
    prior: float = 20.0
    words: int = 1 << 16
    bigrams: int = 1 << 20


class Tokens:
    """Words of some texts in a row: A-Z lowered, cut at ASCII white space."""

    def __init__(self, texts: pa.Array):
        cut = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
        row = np.repeat(np.arange(len(texts)), np.diff(np.asarray(cut.offsets)))
        flat = cut.flatten()
        there = pc.not_equal(flat, "")
        self.row = row[np.asarray(there)]
        word = flat.filter(there).dictionary_encode()
        #: Distinct words; the empty one at the end stands before the first word of a text.
        self.names = pa.concat_arrays([word.dictionary.cast(pa.string()), pa.array([""], pa.string())])
        self.word = np.asarray(word.indices).astype(np.int64)
        self.before = np.full(len(self.word), len(self.names) - 1)
        self.before[1:] = self.word[:-1]
        self.before[np.flatnonzero(np.diff(self.row, prepend=-1))] = len(self.names) - 1
        self.last = np.diff(self.row, append=-1) != 0

    def numbers(self, frequent: pa.Array) -> np.ndarray:
        """Place of each name among the frequent words, -1 if it is none; the empty name's is behind them."""
        at = pc.fill_null(pc.index_in(self.names, value_set=frequent), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        at[-1] = len(frequent)
        return at


def _hashes(names: pa.Array) -> np.ndarray:
    """64 bits per word; words that share them would share their counts."""
    return pd.util.hash_array(names.to_numpy(zero_copy_only=False).astype(object), categorize=False).view(np.int64)


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, whether it is there) of each wanted number among sorted keys."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def _word_counts(texts: DataFrame, name: str) -> DataFrame:
    """(word, n, before): occurrences of each word, and those before another word."""
    def work(batches):
        for batch in slices(batches, "text", AT_ONCE):
            t = Tokens(batch.column("text"))
            n = np.bincount(t.word, minlength=len(t.names))[:-1]
            last = np.bincount(t.word[t.last], minlength=len(t.names))[:-1]
            yield pa.RecordBatch.from_arrays([t.names[:-1], pa.array(n), pa.array(n - last)], ["word", "n", "before"])

    partial = texts.select("text").mapInArrow(work, "word string, n bigint, before bigint")
    return stored(partial.groupBy("word").agg(F.sum("n").alias("n"), F.sum("before").alias("before")), name)


def _above(counts: DataFrame, most: int) -> DataFrame:
    """The rows with the largest ``n``: whole groups of equal ``n``, ``most`` rows at most."""
    sizes = stored(counts.groupBy("n").agg(F.count(F.lit(1)).alias("k")), "lm-sizes")
    total = 0
    for n, k in sizes.orderBy(F.desc("n")).limit(most + 1).toLocalIterator():
        total += k
        if total > most:
            return counts.filter(F.col("n") > n)
    return counts


@dataclass
class Model:
    """What is broadcast: the frequent words with their counts in both models (background, target), by word
    and by hash, and the bigram parts of the frequent bigrams. ``totals``: tokens of both models."""

    spec: Bigrams
    words: pa.Array
    size: int
    totals: tuple[int, int]
    texts: tuple[int, int]
    n: np.ndarray
    before: np.ndarray
    hashes: np.ndarray
    by_hash: np.ndarray
    codes: np.ndarray | None = None
    parts: np.ndarray | None = None

    def share(self, n: np.ndarray, of: int) -> np.ndarray:
        """Unigram probability of words that occur ``n`` times."""
        return (n + self.spec.add) / (self.totals[of] + self.spec.add * self.size)

    def bigram(self, pairs: np.ndarray, word: np.ndarray, of: int) -> np.ndarray:
        return -np.log(pairs + self.spec.prior * self.share(word, of))

    def context(self, before: np.ndarray) -> np.ndarray:
        return np.log(before + self.spec.prior)


def _frequent_bigrams(texts: DataFrame, shared, name: str) -> DataFrame:
    """(code, n) of bigrams of frequent words; the start of a text counts as one."""
    def work(batches):
        words = shared.value.words
        for batch in slices(batches, "text", AT_ONCE):
            t = Tokens(batch.column("text"))
            at = t.numbers(words)
            v, w = at[t.before], at[t.word]
            there = (v >= 0) & (w >= 0)
            code, n = np.unique(v[there] * (len(words) + 1) + w[there], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(code, pa.int64()), pa.array(n, pa.int64())], ["code", "n"])

    return stored(texts.select("text").mapInArrow(work, "code bigint, n bigint").groupBy("code").agg(F.sum("n").alias("n")), name)


def _fit(corpus: DataFrame, aim: DataFrame, spec: Bigrams) -> Model:
    """Counts of all words; the model's frequent part. Totals and the two lists reach the driver."""
    words, aimed = _word_counts(corpus, "lm-words"), _word_counts(aim, "lm-target-words")
    totals = [table.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("before"), F.lit(0))).first() for table in (words, aimed)]
    most = _above(words, spec.words).join(aimed.select("word", F.col("n").alias("nt"), F.col("before").alias("bt")), "word", "left")
    got = most.fillna(0, ["nt", "bt"]).toArrow()
    order = np.argsort(got["word"].to_numpy(zero_copy_only=False).astype(object)) if len(got) else np.zeros(0, int)
    names = got["word"].combine_chunks().cast(pa.string()).take(pa.array(order))
    counts = {c: got[c].to_numpy()[order] for c in ("n", "before", "nt", "bt")}
    # Every text with words has one word that is before no other.
    texts = tuple(t[1] - t[2] for t in totals)
    before = np.stack([np.append(counts[c], texts[i]) for i, c in enumerate(("before", "bt"))])
    hashes = _hashes(names)
    by_hash = np.argsort(hashes)
    model = Model(spec, names, totals[0][0] + 1, (totals[0][1], totals[1][1]), texts, np.stack([counts["n"], counts["nt"]]),
                  before, hashes[by_hash], by_hash)
    shared = corpus.sparkSession.sparkContext.broadcast(model)
    pairs, aims = _frequent_bigrams(corpus, shared, "lm-bigrams"), _frequent_bigrams(aim, shared, "lm-target-bigrams")
    got = _above(pairs, spec.bigrams).join(aims.withColumnRenamed("n", "nt"), "code", "left").fillna(0, ["nt"]).toArrow()
    order = np.argsort(got["code"].to_numpy())
    model.codes = got["code"].to_numpy()[order]
    word = model.codes % (len(names) + 1)
    model.parts = np.stack([model.bigram(got[c].to_numpy()[order], model.n[i][word], i) for i, c in enumerate(("n", "nt"))])
    return model


_ROWS = "wh bigint, vh bigint, r bigint, counts bigint, doc_id {}, lb double, lt double"
_NAMES = ["wh", "vh", "r", "counts", "doc_id", "lb", "lt"]


def _dealt_rows(texts: DataFrame, shared, aim: bool) -> DataFrame:
    """One row per text with its tokens and what the lists say of them (not for the target), and one row per text
    (all of the target's texts as one) and bigram beyond the lists."""
    kind = texts.schema["doc_id"].dataType.simpleString()

    def work(batches):
        model = shared.value
        for batch in slices(batches, "text", AT_ONCE):
            t, rows = Tokens(batch.column("text")), batch.num_rows
            at, hashes = t.numbers(model.words), _hashes(t.names)
            v, w = at[t.before], at[t.word]
            place, hit = _find(model.codes, np.where((v >= 0) & (w >= 0), v * (len(model.words) + 1) + w, -1))
            none = pa.nulls(rows, pa.int64())
            if not aim:
                sums = [np.bincount(t.row, np.where(hit, model.parts[i][place] if len(model.codes) else 0.0, 0.0)
                                    + np.where(v >= 0, model.context(model.before[i])[v], 0.0), rows).astype(float) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays(
                    [none, none, batch.column("r"), pa.array((np.bincount(t.row, minlength=rows) << COUNT) + WHOLE),
                     batch.column("doc_id"), *map(pa.array, sums)], _NAMES)
            row = np.zeros(len(t.row), np.int64) if aim else t.row
            pairs, pair = np.unique((t.before * len(t.names) + t.word)[~hit], return_inverse=True)
            keys, entry, n = np.unique(row[~hit] * max(1, len(pairs)) + pair, return_inverse=True, return_counts=True)
            last = np.bincount(entry, t.last[~hit], len(keys)).astype(np.int64)
            owner, pair = keys // max(1, len(pairs)), pairs[keys % max(1, len(pairs))] if len(pairs) else keys
            word = pair % len(t.names)
            marks = np.where(at[word] >= 0, KNOWN, 0) + (AIM if aim else 0)
            empty = pa.nulls(len(keys), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes[word]), pa.array(hashes[pair // len(t.names)]),
                 pa.nulls(len(keys), pa.int64()) if aim else batch.column("r").take(pa.array(owner)),
                 pa.array((n << COUNT) + (last << LAST) + marks), pa.nulls(len(keys), batch.column("doc_id").type), empty, empty], _NAMES)

    return texts.select("r", "doc_id", "text").mapInArrow(work, _ROWS.format(kind))


def _per_text(rows: pa.Table, model: Model) -> pa.RecordBatch:
    """(r, doc_id, n, lb, lt): sums of texts as they came, and those of the other rows, which hold whole words."""
    counts = rows["counts"].to_numpy()
    sums_of = counts & MARKS == WHOLE
    whole, rest = rows.filter(pa.array(sums_of)), rows.filter(pa.array(~sums_of))
    tokens, counts = counts[sums_of] >> COUNT, counts[~sums_of]
    marks, n, last = counts & MARKS, counts >> COUNT, (counts >> LAST) & ((1 << COUNT - LAST) - 1)
    wh, vh = rest["wh"].to_numpy(), rest["vh"].to_numpy()
    word, word_of = np.unique(wh, return_inverse=True)
    order = np.lexsort((vh, wh))
    new = np.append(True, (np.diff(wh[order]) != 0) | (np.diff(vh[order]) != 0))[:len(order)]
    pair_of = np.empty(len(order), np.int64)
    pair_of[order] = np.cumsum(new) - 1
    aim, known = (marks & AIM) != 0, (marks & KNOWN) != 0
    place, there = _find(model.hashes, word)
    losses = []
    for of, mine in enumerate((~aim, aim)):
        pairs = np.bincount(pair_of, n * mine)[pair_of] if len(n) else n
        words = np.bincount(word_of, n * mine, len(word))
        before = np.bincount(word_of, (n - last) * mine, len(word))
        if there.any():
            words[there] = model.n[of][model.by_hash[place[there]]]
        loss = n * model.bigram(pairs, words[word_of], of) + np.where(known, 0.0, (n - last) * model.context(before[word_of]))
        losses.append(loss[~aim])
    r, at = np.unique(rest["r"].to_numpy(zero_copy_only=False)[~aim].astype(np.int64), return_inverse=True)
    sums = [pa.array(np.bincount(at, loss, len(r)).astype(float)) for loss in losses]
    mine = [pa.array(r), pa.nulls(len(r), whole["doc_id"].type), pa.nulls(len(r), pa.int64()), *sums]
    theirs = [whole["r"].combine_chunks(), whole["doc_id"].combine_chunks(), pa.array(tokens), *[whole[c].combine_chunks() for c in ("lb", "lt")]]
    return pa.RecordBatch.from_arrays([pa.concat_arrays(pair) for pair in zip(theirs, mine)], ["r", "doc_id", "n", "lb", "lt"])


def cross_entropy_difference(docs: DataFrame, target: DataFrame, spec: Bigrams = Bigrams(), doc_id: str = "doc_id",
                             text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, target_loss, background_loss, score) for each row of ``docs``.

    ``target`` has the texts (column ``text``) of the target model; the background model counts all of
    ``docs``. The vocabulary is all words of ``docs`` and one entry for the target's other words. Losses are
    nats per token. A text without words, or NULL, has NULL losses and score. Repeated rows count each time. With
    an empty ``target``, its model is uniform. Other columns do not matter.
    """
    corpus = docs.select(F.monotonically_increasing_id().alias("r"), F.col(f"`{doc_id}`").alias("doc_id"),
                         F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    aim = target.select(F.lit(None).cast("bigint").alias("r"), F.lit(None).cast(corpus.schema["doc_id"].dataType).alias("doc_id"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(_fit(corpus, aim, spec))
    rows = _dealt_rows(corpus, shared, False).unionByName(_dealt_rows(aim, shared, True))
    # Rows of a rare word together, rows of a bigram of a frequent word together; not shipped, but computed on both sides.
    cell = (F.when(F.col("counts").bitwiseAND(WHOLE) != 0, F.xxhash64("r"))
            .when(F.col("counts").bitwiseAND(KNOWN) != 0, F.xxhash64("wh", "vh")).otherwise(F.col("wh")))
    cells = rows.repartition(cell).withColumn("cell", cell).sortWithinPartitions("cell")

    def work(batches):
        for part in whole_cells(batches, 1 << 16):
            yield _per_text(part, shared.value)

    kind = corpus.schema["doc_id"].dataType.simpleString()
    sums = cells.mapInArrow(work, f"r bigint, doc_id {kind}, n bigint, lb double, lt double").groupBy("r").agg(
        F.max(F.struct("n", "doc_id")).alias("of"), *[F.sum(c).alias(c) for c in ("lb", "lt")])
    n = F.nullif(F.col("of.n"), F.lit(0))
    return sums.select("of.doc_id", F.col("of.n").alias("n_tokens"), (F.col("lt") / n).alias("target_loss"),
                       (F.col("lb") / n).alias("background_loss"), ((F.col("lt") - F.col("lb")) / n).alias("score"))
