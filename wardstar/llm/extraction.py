"""Main text of web pages by a conditional random field over DOM leaf blocks.

A page becomes its leaf blocks in order (``dom.py``).  A block's features are
the tags and names above it, its own and its parent's tag, and what its text is
like: length, share inside links, signs, first words.  Every block is labelled
article or not by Viterbi, so a paragraph that could be either follows its
neighbours; the article's blocks are the text, joined by an empty line.

The field is fitted on the driver on ``PAGES`` labelled pages
(``labelled_pages.py``), the same at every size of input.

Defined results: a null or empty page, and one without an article, has empty
text; malformed markup is read as far as it goes; a null page_id or url stays;
rows that repeat get equal results; no rows give no rows.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardstar.llm.common import table
from wardstar.llm.crf import Crf, fit, viterbi
from wardstar.llm.dom import Block, Place, leaf_blocks
from wardstar.llm.labelled_pages import labelled_pages

DIMS = 1 << 16
PAGES = 1200  # labelled pages fitted on
MARK = "\x02"  # stands before the text of an article's block in a labelled page
_FIRST = re.compile(r"[^\W\d_]+")


@functools.lru_cache(maxsize=1 << 14)
def _number(feature: str) -> int:
    return zlib.crc32(feature.encode()) % DIMS


@functools.lru_cache(maxsize=1 << 12)
def _of_place(tags: frozenset[str], names: frozenset[str], tag: str, parent: str) -> tuple[int, ...]:
    """Features of where a block stands."""
    found = {f"in:{t}" for t in tags} | {f"name:{n}" for n in names}
    found |= {f"tag:{tag}", f"parent:{parent}", f"pair:{f'{parent}>{tag}' if parent else tag}", "bias"}
    return tuple(sorted(_number(f) for f in found))


def _stands(place: Place | None) -> tuple[int, ...]:
    if place is None:
        return _of_place(frozenset(), frozenset(), "", "")
    return _of_place(place.all_tags, place.all_words, place.tag, place.above.tag if place.above else "")


def features(block: Block, place: int, total: int) -> list[int]:
    text = block.text
    size = min(10, len(text).bit_length())
    links = min(4, 4 * block.linked // max(1, len(text)))
    tail = text[-1]
    found = [f"size:{size}", f"links:{links}", f"both:{size},{links}", "end:" + (tail if tail in ".!?:" else ""), f"at:{4 * place // total}", f"c:{'©' in text[:80]}"]
    if size <= 7:  # what short blocks say
        found += [f"says:{w}" for w in _FIRST.findall(text.lower())[:6]]
    return [*_stands(block.place), *map(_number, found)]


def _laid_out(pages: list[list[Block]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    found = [features(b, i, len(blocks)) for blocks in pages for i, b in enumerate(blocks)]
    counts = np.fromiter(map(len, found), np.int64, len(found))
    lengths = np.array([len(blocks) for blocks in pages if blocks], np.int64)
    return np.fromiter((f for x in found for f in x), np.int64, int(counts.sum())), counts, lengths


def learn(pages: int = PAGES, seed: int = 17) -> Crf:
    marked = [leaf_blocks(page) for page in labelled_pages(pages, seed)]
    labels = np.array([b.text.startswith(MARK) for blocks in marked for b in blocks], np.int64)
    plain = [[b._replace(text=b.text.removeprefix(MARK)) for b in blocks] for blocks in marked]
    return fit(*_laid_out(plain), labels, 2, DIMS, epochs=6, batch=32)


def main_blocks(pages: list[list[Block]], model: Crf) -> list[list[str]]:
    """Texts of the article's blocks of each page."""
    if not any(pages):
        return [[] for _ in pages]
    found, counts, lengths = _laid_out(pages)
    labels = iter(viterbi(model.emissions(found, counts), lengths, model.transitions, model.start).tolist())
    return [[b.text for b in blocks if next(labels)] for blocks in pages]


def extract(pages: DataFrame, model: Crf | None = None) -> DataFrame:
    """``pages`` with html replaced by text and n_blocks, the number of the article's blocks."""
    shared = pages.sparkSession.sparkContext.broadcast(model or learn())
    keep = [c for c in pages.columns if c not in ("html", "text", "n_blocks")]
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in pages.schema if f.name in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, 256) for b in batches for at in range(0, b.num_rows, 256)):
            found = main_blocks([leaf_blocks(x) for x in batch.column("html").to_pylist()], shared.value)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(["\n\n".join(x) for x in found], pa.string()), pa.array([len(x) for x in found], pa.int32())],
                names=[*keep, "text", "n_blocks"],
            )

    return pages.select(*[F.col(f"`{c}`") for c in keep], "html").mapInArrow(run, f"{schema}text string, n_blocks int")


def op4_html_extraction(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


QUERIES = {"op4_html_extraction": op4_html_extraction}
