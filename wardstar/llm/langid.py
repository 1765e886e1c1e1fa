"""Language identification of words by a linear-chain conditional random field.

A sentence (up to a full stop, ! or ?, or a line end) is a sequence of words (runs
of letters, lower-cased).  A
word's features are hashed: the word itself (the lexicon), its first and last
one to three letters (affixes) and its letter pairs and triples with word
boundaries (n-grams).  Learned transitions say how likely a language is
followed by itself or another, so words shared by languages follow their
neighbours and a switch inside a sentence is found.  Forward-backward gives every
word a probability per language; a document's language is the one with the
largest sum, its score that sum's share of the words.

The field is fitted on the driver on a bounded sample: per language the
``QUOTA`` documents with the least hash of their id, of each at most
``PIECES`` runs of ``RUN`` words spread over the text; runs of several
documents are joined to one sequence, which is where transitions are learned.
All documents are labelled, whole texts.

Defined results: a text that is null or has no letter is ``und`` with score 0;
without any learned language every text is; null ids are neither learned from
nor held out, null languages not learned; rows that repeat get equal results;
ties go to the language first in order; no rows give no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardstar.llm.common import fold, small_batches, table, worker_held
from wardstar.llm.crf import Crf, fit, marginals

DIMS = 1 << 17
QUOTA = 300  # documents learned from per language, at most
PIECES, RUN = 5, 24
UNKNOWN = "und"
_WORD = re.compile(r"[^\W\d_]+")
_BREAK = re.compile(r"[\n.!?]+")
_CACHE = 1 << 16  # words whose emissions a worker keeps
_WORDS = 1 << 16  # words labelled at once, but for a longer document


_BASE, _MIX = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)


def _slots(keys: np.ndarray, kind: int) -> np.ndarray:
    return ((keys * _BASE + np.uint64(kind)) * _MIX >> np.uint64(64 - DIMS.bit_length() + 1)).astype(np.int64)


class WordFeatures:
    """Feature numbers of lower-cased words; ``DIMS`` stands for none.

    ``grams`` has one row per letter or boundary and a column per n-gram that
    begins there; ``whole`` one row per word: its first and last three letters
    with the boundary (shorter affixes are n-grams at a boundary) and itself.
    """

    def __init__(self, words: list[str]):
        codes = np.frombuffer(f"<{'><'.join(words)}>".encode("utf-32-le"), np.uint32).astype(np.uint64)
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
        self.begins = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        room = np.repeat(self.begins + sizes, sizes) - np.arange(len(codes))  # letters from here to the word's end
        padded = np.concatenate([codes, np.zeros(3, np.uint64)])
        keys, columns = padded[: len(codes)], []
        for n in (2, 3, 4):
            keys = keys * _BASE + padded[n - 1 : len(codes) + n - 1]
            columns.append(np.where(room >= n, _slots(keys, n), DIMS))
        ends = self.begins + sizes
        prefix = columns[2][self.begins]
        suffix = columns[2][np.maximum(ends - 4, self.begins)]
        place = np.arange(len(codes)) - np.repeat(self.begins, sizes)
        powers = np.cumprod(np.full(int(sizes.max()), _BASE, np.uint64))
        itself = _slots(np.add.reduceat(codes * powers[place], self.begins), 9)
        self.grams = np.stack(columns[:2], 1)
        self.whole = np.stack([prefix, suffix, itself], 1)

    def ragged(self) -> tuple[np.ndarray, np.ndarray]:
        """All features in order of their word, and how many each word has."""
        of_letter = np.repeat(np.arange(len(self.begins)), np.diff(np.append(self.begins, len(self.grams))))
        found = np.concatenate([self.grams.ravel(), self.whole.ravel()])
        word = np.concatenate([np.repeat(of_letter, 2), np.repeat(np.arange(len(self.begins)), 3)])
        word, found = word[found < DIMS], found[found < DIMS]
        return found[np.argsort(word, kind="stable")], np.bincount(word, minlength=len(self.begins))

    def emissions(self, weights: np.ndarray) -> np.ndarray:
        """Summed weights per word; the last row of ``weights`` is zero."""
        by_letter = weights[self.grams[:, 0]] + weights[self.grams[:, 1]]
        return np.add.reduceat(by_letter, self.begins, axis=0) + weights[self.whole].sum(1)


def sentences(text: str | None) -> list[list[str]]:
    """Words of each sentence that has any."""
    return [w for part in _BREAK.split(text.lower()) if (w := _WORD.findall(part))] if text else []


def _runs(text: str) -> list[list[str]]:
    words = _WORD.findall(text.lower())
    if len(words) <= RUN * PIECES:
        return [words[i : i + RUN] for i in range(0, len(words), RUN)]
    return [words[i : i + RUN] for i in np.linspace(0, len(words) - RUN, PIECES).astype(int).tolist()]


def learn(texts: list[str], langs: list[str], seed: int = 5) -> tuple[list[str], Crf | None]:
    """Languages in order and the field fitted to whole-text labels."""
    names = sorted(set(langs))
    runs = [(run, names.index(lang)) for text, lang in zip(texts, langs) for run in _runs(text) if run]
    if not runs:
        return [], None
    rnd = np.random.default_rng(seed)
    rnd.shuffle(runs)
    sequences, at = [], 0
    while at < len(runs):  # a third of the sequences have one run, the others two or three
        size = int(rnd.integers(1, 4))
        sequences.append(runs[at : at + size])
        at += size
    words = [w for s in sequences for run, _ in s for w in run]
    labels = np.array([y for s in sequences for run, y in s for _ in run])
    found, counts = WordFeatures(words).ragged()
    lengths = np.array([sum(len(run) for run, _ in s) for s in sequences])
    return names, fit(found, counts, lengths, labels, len(names), DIMS, epochs=4)


class Labeller:
    """Label probabilities of words; emissions of the first ``_CACHE`` different words are kept."""

    def __init__(self, names: list[str], model: Crf):
        self.names, self.model = names, model
        self.weights = np.concatenate([model.weights, np.zeros((1, len(names)))])
        self.place: dict[str, int] = {}
        self.kept = np.zeros((_CACHE, len(names)))

    def _emissions(self, words: list[str]) -> np.ndarray:
        place = self.place
        new = list({w for w in words if w not in place})
        if not new:
            return self.kept[np.fromiter(map(place.__getitem__, words), np.int64, len(words))]
        more = np.concatenate([WordFeatures(new[i : i + 20_000]).emissions(self.weights) for i in range(0, len(new), 20_000)])
        room = min(len(new), _CACHE - len(place))
        self.kept[len(place) : len(place) + room] = more[:room]
        place.update(zip(new[:room], range(len(place), len(place) + room)))
        rest = dict(zip(new[room:], range(len(place), len(place) + len(new) - room)))
        if not rest:
            return self._emissions(words)
        numbers = [place[w] if w in place else rest[w] for w in words]
        return np.concatenate([self.kept[: len(place)], more[room:]])[numbers]

    def words(self, lines: list[list[str]]) -> np.ndarray:
        """Probability of each language for each word of the sentences."""
        emissions = self._emissions([w for line in lines for w in line])
        lengths = np.fromiter(map(len, lines), np.int64, len(lines))
        return marginals(emissions, lengths, self.model.transitions, self.model.start)[0]

    def texts(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and score of each text."""
        langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        waiting: list[tuple[int, list[list[str]]]] = []

        def done() -> None:
            every = self.words([line for _, lines in waiting for line in lines])
            sizes = np.array([sum(map(len, lines)) for _, lines in waiting])
            sums = np.add.reduceat(every, np.concatenate([[0], np.cumsum(sizes)[:-1]]), axis=0)
            for (row, _), total, size in zip(waiting, sums, sizes):
                best = int(total.argmax())
                langs[row], scores[row] = self.names[best], min(1.0, float(total[best] / size))
            waiting.clear()

        words = 0
        for row, text in enumerate(texts):
            lines = sentences(text)
            if any(c.isalpha() for line in lines for w in line for c in w):  # the first, as a rule
                waiting.append((row, lines))
                words += sum(map(len, lines))
                if words >= _WORDS:
                    done()
                    words = 0
        if waiting:
            done()
        return langs, scores


def _labeller(name: str, parts: tuple) -> Labeller:
    """One per Python worker, so that its cache serves all tasks there."""
    return worker_held(f"labeller {name}", lambda: Labeller(*parts))


def train(docs: DataFrame, quota: int = QUOTA) -> tuple[list[str], Crf | None]:
    """Fit on a sample of ``docs`` (doc_id, text, lang); rows with a null in any of them are not learned from."""
    known = docs.where("doc_id is not null and text is not null and lang is not null")
    by_hash = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    slim = known.select("doc_id", "lang").withColumn("n", F.row_number().over(by_hash)).where(F.col("n") <= quota).drop("n")
    # quota rows per language at most
    rows = known.join(F.broadcast(slim.distinct()), ["doc_id", "lang"]).select("doc_id", "text", "lang")
    got = sorted(((r.doc_id, r.lang, r.text) for r in rows.collect()))
    return learn([r[2] for r in got], [r[1] for r in got])


def identify(docs: DataFrame, names: list[str], model: Crf | None) -> DataFrame:
    """``docs`` with lang_pred and score."""
    context = docs.sparkSession.sparkContext
    shared = context.broadcast((names, model))
    name = f"{context.applicationId}-{shared._jbroadcast.id()}"
    keep = [c for c in docs.columns if c not in ("lang_pred", "score")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = _labeller(name, shared.value) if shared.value[1] else None
        for batch in (b.slice(at, 1024) for b in batches for at in range(0, b.num_rows, 1024)):
            texts = batch.column("text").to_pylist()
            langs, scores = labeller.texts(texts) if labeller else ([UNKNOWN] * len(texts), [0.0] * len(texts))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[*keep, "lang_pred", "score"])

    return small_batches(docs).select(*[F.col(f"`{c}`") for c in keep]).mapInArrow(run, f"{schema}, lang_pred string, score double")


def op10_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False))
    names, model = train(docs.where(~held))
    rows = docs.select("doc_id", held.alias("held_out"), "text")
    return identify(rows, names, model).select("doc_id", "held_out", "lang_pred", "score")


QUERIES = {"op10_language_id": op10_language_id}
