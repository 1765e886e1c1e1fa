"""Language-model scoring by prediction by partial matching.

A text is taken as its words, lower-cased and joined by single spaces, and an
end.  The model is a pretrained byte-context trie (``trie.py``): counts of all
grams of ``order + 1`` bytes of all training texts, gathered in one pass that
combines per task before it shuffles; shorter grams are sums of longer ones.
What a task holds is bounded, the model is not: tasks get the probabilities, from
full counts, of the longest grams whose count reaches the least power of two
that leaves at most ``GRAMS`` of them.  Every other symbol of a document, new
ones and their escapes included, is joined: different missing grams meet the
written counts by the ``SHORT`` bytes before the symbol, where all longer
contexts of a symbol stand together, and get their scores from the trie of
those.  Grams of at most ``SHORT`` bytes, 2^24 whatever the corpus, go to every
task of that step.

Beside the trie the same pass counts words for a unigram baseline with add-one
smoothing.  Its vocabulary grows with the corpus: at most ``WORDS`` of the most
frequent words go to the tasks, every other word of a document is joined to the
full table of counts.

Defined results: null and empty texts are the end alone; a null doc_id is not
held out; rows that repeat are scored each; without any training text every
byte is equally likely and no token is known; no rows give no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardstar.llm.common import fold, grouped, staged, table
from wardstar.llm.trie import Longest, Trie, normalised, packed, shortened

ORDER = 5
GRAMS = 1 << 19  # longest grams that tasks get, at most
SHORT = 3  # bytes of the grams that all tasks get when the others are joined
WORDS = 1 << 18  # words that tasks get, at most
_KEYS = 1 << 21  # keys counted at once
_DISTINCT = 1 << 20  # keys kept with a count before they are sent on
_VOCABULARY = 1 << 17  # different words counted at once
_JOINED = 1 << 18  # longest grams that a joined trie is built of, or one context's
_BYTES = 1 << 17  # bytes scored at once, which stay in a core's cache
END_WORD = b"\n"
_BUILT: dict[str, tuple] = {}  # the model of a Python worker


def _slices(texts: Iterator[bytes], size: int) -> Iterator[list[bytes]]:
    held, total = [], 0
    for t in texts:
        held.append(t)
        total += len(t)
        if total >= size:
            yield held
            held, total = [], 0
    if held:
        yield held


def corpus_counts(train: DataFrame, order: int = ORDER) -> DataFrame:
    """Counts of all ``order + 1``-byte grams (gram, packed) and all words (word) of ``train(text)``: gram, word, n."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _BUILT.clear()  # a worker that scored before
        words: Counter = Counter()
        keys: list[np.ndarray] = []
        found: list[tuple[np.ndarray, np.ndarray]] = []

        def out(gram: pa.Array, word: pa.Array, n: pa.Array) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([gram, word, n], names=["gram", "word", "n"])

        def count() -> None:
            counted = pc.value_counts(pa.array(np.concatenate(keys).view(np.int64)))
            found.append((counted.field(0).to_numpy().copy(), counted.field(1).to_numpy().copy()))
            keys.clear()
            del counted
            pa.default_memory_pool().release_unused()

        def grams() -> pa.RecordBatch:
            gram, n = (np.concatenate(x) for x in zip(*found))
            found.clear()
            by = np.argsort(gram)
            gram, n = gram[by], n[by]
            first = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]]))
            gram, n = pa.array(gram[first]), pa.array(np.add.reduceat(n, first))
            return out(gram, pa.nulls(len(gram), pa.binary()), n)

        def vocabulary() -> pa.RecordBatch:
            word, n = pa.array(words.keys(), pa.binary()), pa.array(words.values(), pa.int64())
            words.clear()
            return out(pa.nulls(len(word), pa.int64()), word, n)

        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                for texts in _slices(map(normalised, batch.column(0).slice(at, 512).to_pylist()), _BYTES):
                    for text in texts:
                        words.update(text.split())
                    words[END_WORD] += len(texts)
                    keys.append(packed(texts, order)[0])
                    if sum(map(len, keys)) >= _KEYS:
                        count()
                        if sum(len(k) for k, _ in found) >= _DISTINCT:
                            yield grams()
                    if len(words) >= _VOCABULARY:
                        yield vocabulary()
        if words:
            if keys:
                count()
            if found:
                yield grams()
            yield vocabulary()

    found = train.select(F.col("text").cast("binary").alias("text")).mapInArrow(run, "gram long, word binary, n long")
    return found.groupBy("gram", "word").agg(F.sum("n").alias("n"))


def _least_power(levels: dict[int, int], bound: int) -> int:
    """The least power of two that at most ``bound`` counts reach; levels: number of counts by floor(log2)."""
    power = max(levels, default=0) + 1
    kept = 0
    while power and kept + levels.get(power - 1, 0) <= bound:
        power -= 1
        kept += levels.get(power, 0)
    return 1 << power


_LEVEL = "length(bin(n)) - 1"


def frequent_grams(longest: DataFrame, bound: int = GRAMS) -> tuple[np.ndarray, np.ndarray]:
    """Packed keys and log10 probabilities of the grams that tasks get, of ``longest(gram, n)``."""
    levels = dict(tuple(r) for r in longest.groupBy(F.expr(_LEVEL)).count().collect())
    whole = F.sum("n").over(Window.partitionBy(F.shiftright("gram", 8)))
    rows = longest.withColumn("whole", whole).where(F.col("n") >= _least_power(levels, bound))
    rows = rows.select("gram", F.log10((2 * F.col("n") - 1) / (2 * F.col("whole"))).alias("log")).toArrow()
    return rows.column(0).to_numpy().astype(np.uint64), rows.column(1).to_numpy()


def joined_grams(asked: DataFrame, longest: DataFrame, order: int) -> DataFrame:
    """gram, log: the log10 probability of every packed symbol of ``asked(gram)`` by all grams of ``longest(gram, n)``."""
    length = min(SHORT, order + 1)
    short = longest.groupBy(F.col("gram").bitwiseAND(F.lit((1 << 8 * length) - 1)).alias("gram")).agg(F.sum("n").alias("n")).toArrow()
    of = short.column(0).to_numpy().astype(np.uint64), short.column(1).to_numpy()
    shared = asked.sparkSession.sparkContext.broadcast([shortened(*of, n) for n in range(1, length + 1)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _BUILT.clear()  # a worker that scored before

        def scored(held: list[pa.Table]) -> pa.RecordBatch:
            rows = pa.concat_tables(held)
            gram, n = rows.column("gram").to_numpy().astype(np.uint64), rows.column("n").to_numpy()
            wanted = gram[n == 0]
            gram, n = gram[n > 0], n[n > 0]
            parts = shared.value + [shortened(gram, n, m) for m in range(length + 1, order + 2)]
            trie = Trie(order, *(np.concatenate(x) for x in zip(*parts)))
            return pa.RecordBatch.from_arrays([pa.array(wanted.view(np.int64)), pa.array(trie.score(wanted))], names=["gram", "log"])

        held: list[pa.Table] = []
        size = 0
        for group in grouped(batches, ("context",)):
            if pc.min(group.column("n")).as_py() == 0:
                held.append(group)
                size += group.num_rows
            if size >= _JOINED:
                yield scored(held)
                held, size = [], 0
        if held:
            yield scored(held)

    rows = longest.select("gram", "n").unionAll(asked.distinct().select("gram", F.lit(0).cast("long")))
    context = F.shiftright("gram", 8).bitwiseAND(F.lit((1 << 8 * SHORT) - 1))
    rows = rows.select(context.alias("context"), "gram", "n").repartition("context").sortWithinPartitions("context")
    return rows.mapInArrow(run, "gram long, log double")


def frequent_words(counts: DataFrame, bound: int = WORDS) -> dict[bytes, int]:
    levels = dict(tuple(r) for r in counts.where("word is not null").groupBy(F.expr(_LEVEL)).count().collect())
    rows = counts.where((F.col("word").isNotNull()) & (F.col("n") >= _least_power(levels, bound))).select("word", "n").toArrow()
    return dict(zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()))


def _model(name: str, parts: Callable[[], tuple]) -> tuple[Longest, dict[bytes, float]]:
    """The gram and the word table, built once in each Python worker."""
    if name not in _BUILT:
        _BUILT.clear()
        order, grams, logs, words = parts()
        _BUILT[name] = Longest(order, grams, logs), words
    return _BUILT[name]


def score_texts(trie: Trie, texts: list[bytes]) -> np.ndarray:
    """log10 probability of each normalised text."""
    out = []
    for some in _slices(iter(texts), _BYTES):
        keys, begins = packed(some, trie.order)
        out.append(np.add.reduceat(trie.score(keys), begins))
    return np.concatenate(out) if out else np.zeros(0)


_MISSING = pa.list_(pa.struct([("gram", pa.int64()), ("times", pa.int64())]))


def known_scores(model: Longest, texts: list[bytes]) -> tuple[np.ndarray, pa.Array]:
    """log10 probability of the known symbols of each normalised text, and its missing ones with how often they come."""
    out, missing = [np.zeros(0)], [pa.array([], _MISSING)]
    for some in _slices(iter(texts), _BYTES):
        keys, begins = packed(some, model.order)
        logs, known = model.score(keys)
        out.append(np.add.reduceat(logs, begins))
        at = np.flatnonzero(~known)
        text, gram = np.searchsorted(begins, at, "right") - 1, keys[at]
        by = np.lexsort((gram, text))
        text, gram = text[by], gram[by]
        first = np.flatnonzero(np.concatenate([[True], (gram[1:] != gram[:-1]) | (text[1:] != text[:-1])])[: len(gram)])
        times = np.diff(np.append(first, len(gram)))
        ends = np.concatenate([[0], np.cumsum(np.bincount(text[first], minlength=len(some)))]).astype(np.int32)
        pairs = pa.StructArray.from_arrays([pa.array(gram[first].view(np.int64)), pa.array(times)], fields=list(_MISSING.value_type))
        missing.append(pa.ListArray.from_arrays(pa.array(ends), pairs, type=_MISSING))
    return np.concatenate(out), pa.concat_arrays(missing)


def lm_scores(docs: DataFrame, held_out, order: int = ORDER, grams: int = GRAMS, words: int = WORDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of ``docs(doc_id, text)``."""
    spark: SparkSession = docs.sparkSession
    held = F.coalesce(held_out, F.lit(False))
    counts = staged(corpus_counts(docs.where(~held).select("text"), order), "lm-counts")
    of_words = counts.where("word is not null")
    total, kinds = of_words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    space = float(total + kinds + 1)
    longest = counts.where("gram is not null").select("gram", "n")
    keys, logs = frequent_grams(longest, grams)
    frequent = {w: math.log10((n + 1) / space) for w, n in frequent_words(counts, words).items()}
    shared = spark.sparkContext.broadcast((order, keys, logs, frequent))
    name = f"{spark.sparkContext.applicationId}-{shared._jbroadcast.id()}"
    kind = docs.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, table_ = _model(name, lambda: shared.value)
        known = table_.get
        rare_type = pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())]))
        for batch in (b.slice(at, 512) for b in batches for at in range(0, b.num_rows, 512)):
            texts = [normalised(x) for x in batch.column("text").to_pylist()]
            base, sizes, found, rare = [], [], [], []
            for text in texts:
                tokens = [*text.split(), END_WORD]
                logs = list(map(known, tokens))
                missing = Counter([w for w, x in zip(tokens, logs) if x is None]) if None in logs else {}
                base.append(math.fsum(x for x in logs if x is not None))
                sizes.append(len(tokens))
                found.append(len(tokens) - sum(missing.values()))
                rare.append([{"word": w, "n": n} for w, n in missing.items()])
            score, missing = known_scores(model, texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), batch.column("held_out"), pa.array(sizes, pa.int64()),
                 pa.array(found, pa.int64()), pa.array(base, pa.float64()), pa.array(score), pa.array(rare, rare_type), missing],
                names=["row", "doc_id", "held_out", "n_tokens", "found", "base", "score", "rare", "missing"],
            )

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", held.alias("held_out"), F.col("text").cast("binary").alias("text")
    )
    schema = (f"row long, doc_id {kind.simpleString()}, held_out boolean, n_tokens long, found long, base double, score double, "
              "rare array<struct<word:binary,n:long>>, missing array<struct<gram:long,times:long>>")
    scored = staged(rows.mapInArrow(run, schema), "lm-scored")
    shared.destroy()

    rare = scored.select("row", F.explode("rare").alias("r")).select("row", "r.word", F.col("r.n").alias("times"))
    rare = rare.join(of_words.select("word", "n"), "word", "left").select(
        "row",
        (F.col("times") * F.log10((F.coalesce("n", F.lit(0)) + 1) / F.lit(space))).alias("more"),
        F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0).alias("also"),
        F.lit(0.0).alias("gained"),
    )
    missing = scored.select("row", F.explode("missing").alias("m")).select("row", "m.gram", "m.times")
    missing = missing.join(joined_grams(missing.select("gram"), longest, order), "gram")
    missing = missing.select("row", F.lit(0.0).alias("more"), F.lit(0).cast("long").alias("also"), (F.col("times") * F.col("log")).alias("gained"))
    rest = rare.unionAll(missing).groupBy("row").agg(*(F.sum(c).alias(c) for c in ("more", "also", "gained")))
    return scored.join(rest, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("found") + F.coalesce("also", F.lit(0))).alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("gained", F.lit(0.0))).alias("score"),
    )


def op5_lm_scoring(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lm_scores(docs, fold(F.col("doc_id"), 7) == 2)


QUERIES = {"op5_lm_scoring": op5_lm_scoring}
