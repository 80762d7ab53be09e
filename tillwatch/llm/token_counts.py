"""Token counts by a subword model, from the lengths of pre-tokens.

No piece of the model holds a blank behind another character (checked when it is loaded), so no merge crosses
a place where blanks begin: a text has as many tokens as its pre-tokens, each a run of blanks and
what follows it, counted alone. A task looks a pre-token's length up twice: in a broadcast hash table of
frequent pre-tokens, then in the cache of its worker process, which the model fills on a miss. Texts and
pre-tokens are never shuffled.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache
from itertools import chain, islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwatch.llm.common import fresh, slices

#: Entries of the broadcast table, and the longest pre-token it holds, in characters: 4 MB at most.
FREQUENT, LONGEST = 1 << 15, 32
#: Documents, and their largest size in bytes, whose pre-tokens are counted for that table on the driver.
#: They decide only which lengths are looked up and which are computed, never a count.
SAMPLE, SAMPLE_BYTES = 2048, 1 << 14
#: Pre-tokens that a worker process remembers; then its cache starts anew.
REMEMBERED = 1 << 18
#: Texts above so many characters are cut at blanks and counted part by part.
PART = 1 << 20
#: Bytes of text worked on at once.
AT_ONCE = 4 << 20

_BLANK = "▁"
_RUNS = re.compile(" +[^ ]*")


def pre_tokens(text: str) -> list[str]:
    """Runs of blanks with what follows, each without its first blank; the model puts one before the text."""
    text = text.replace(_BLANK, " ")
    if text.startswith(" ") or text.endswith(" ") or "  " in text:
        return [run[1:] for run in _RUNS.findall(" " + text)]
    return text.split(" ")


def parts(text: str) -> list[list[str]]:
    """Pre-tokens of a text, long texts in several lists; an empty text has none."""
    if not text:
        return []
    if len(text) <= PART:
        return [pre_tokens(text)]
    runs = (run.group()[1:] for run in _RUNS.finditer(" " + text.replace(_BLANK, " ")))
    return list(iter(lambda: list(islice(runs, 1 << 17)), []))


class Model:
    """Lengths of pre-tokens, and those already known to this process."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = map(self.model.id_to_piece, range(self.model.get_piece_size()))
        if any(re.search(f"[^{_BLANK}]{_BLANK}", piece) for piece in pieces) or self.model.normalize("a  b ") != f"{_BLANK}a{_BLANK * 2}b{_BLANK}":
            raise ValueError("the model's pieces cross blanks, or it changes blanks: pre-tokens do not stand alone")
        self.seen: dict[str, int] = {}

    def lengths(self, words: list[str]) -> list[int]:
        """Tokens of each pre-token; blanks alone are counted behind another character."""
        found = [len(ids) for ids in self.model.encode(words, num_threads=1)]
        for i, word in enumerate(words):
            if not word.strip(" "):
                found[i] = len(self.model.encode("a " + word)) - len(self.model.encode("a"))
        return found

    def all_lengths(self, words: set[str], frequent: dict[str, int]) -> dict[str, int]:
        """Two tiers: the frequent ones, then those this process has met; the rest is encoded."""
        known = {word: frequent[word] for word in words if word in frequent}
        rest = words - known.keys()
        if len(self.seen) > REMEMBERED:
            self.seen.clear()
        missing = [word for word in rest if word not in self.seen]
        new = dict(zip(missing, self.lengths(missing)))
        self.seen.update((word, n) for word, n in new.items() if len(word) <= 4 * LONGEST)
        known.update(new)
        known.update((word, self.seen[word]) for word in rest if word not in new)
        return known


@lru_cache(maxsize=2)
def model_of(path: str) -> Model:
    """One per process, whatever number of tasks it runs."""
    return Model(path)


def frequent_lengths(docs: DataFrame, path: str, text: str = "text") -> dict[str, int]:
    """Lengths of the most frequent pre-tokens of a bounded sample of short documents."""
    whole = F.col(f"`{text}`").cast("string")
    rows = (docs.filter((F.octet_length(whole) <= SAMPLE_BYTES) & (F.pmod(F.xxhash64(whole), F.lit(8)) == 0))
            .select(whole.alias("text")).take(SAMPLE))
    counts = Counter(chain.from_iterable(pre_tokens(row["text"]) for row in rows if row["text"]))
    words = [word for word, _ in counts.most_common(FREQUENT) if len(word) <= LONGEST]
    return dict(zip(words, model_of(path).lengths(words)))


def count_tokens(docs: DataFrame, path: str, text: str = "text", into: str = "n_tokens") -> DataFrame:
    """Replace ``text`` by ``into``, the tokens of the whole text without begin and end.

    ``path`` names a model file that the driver and every executor can open. Strings of special tokens inside a
    text are ordinary text, as in the library. NULL and empty texts have 0. All rows and other columns stay;
    ``into`` gets an underscore where there is a column of its name. A text without any blank is one pre-token
    and is encoded whole.
    """
    kept = docs.drop(text)
    rest = kept.columns
    into, source = fresh(kept, into), fresh(kept, "text")
    shared = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, path, text))

    def work(batches):
        model, frequent = model_of(path), shared.value
        for batch in slices(batches, source, AT_ONCE):
            lists = [parts(t) for t in batch.column(source).to_pylist()]
            length = model.all_lengths(set(chain.from_iterable(chain.from_iterable(lists))), frequent)
            counts = [sum(sum(map(length.__getitem__, part)) for part in one) for one in lists]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), pa.array(counts, pa.int64())], names=[*rest, into])

    whole = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias(source)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields] + [f"`{into}` bigint"])
    return docs.select(*[F.col(f"`{c}`") for c in rest], whole).mapInArrow(work, schema)
