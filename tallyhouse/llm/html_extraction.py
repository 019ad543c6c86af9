"""Main text of HTML pages: every block is labelled by a recurrent model, the article is kept.

The model is trained once by the driver, from pages made of templates, and its
weights, of fixed size, go out with the tasks. Pages are read whole.

A null or empty page, and one without article, has an empty text. Repeated rows are
read each. Columns beside id, URL and HTML are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.block_labeller import Labeller, trained, vector
from tallyhouse.llm.common import slices
from tallyhouse.llm.html_blocks import Block, blocks

CUT = 0.5
# Pages read together, and blocks in them with the padding to the longest.
PAGES_AT_ONCE = 256
BLOCKS_AT_ONCE = 16_384
# A page of more blocks is read in pieces that have so many of their neighbours' on either side.
AROUND = 1024


def _long_scores(found: list[Block], labeller: Labeller) -> np.ndarray:
    """Scores of a page of very many blocks, a piece at a time with what stands around it."""
    out = []
    for start in range(0, len(found), BLOCKS_AT_ONCE):
        low, stop = max(start - AROUND, 0), min(start + BLOCKS_AT_ONCE, len(found))
        piece = np.stack([vector(block) for block in found[low:stop + AROUND]])
        out.append(labeller.scores([piece])[0][start - low:stop - low])
    return np.concatenate(out)


def main_texts(pages: list[str | None], labeller: Labeller) -> list[str]:
    """The article of each page, its blocks joined by spaces."""
    cut = [blocks(page) for page in pages]
    out = [""] * len(pages)
    order = sorted((n for n, page in enumerate(cut) if page), key=lambda n: len(cut[n]))
    while order:
        # Pages of like length go together; the last, the longest, sets the padding.
        longest = len(cut[order[-1]])
        if longest > BLOCKS_AT_ONCE:
            n = order.pop()
            out[n] = _kept(cut[n], _long_scores(cut[n], labeller))
            continue
        some = order[-min(PAGES_AT_ONCE, max(1, BLOCKS_AT_ONCE // longest)):]
        del order[-len(some):]
        found = labeller.scores([np.stack([vector(block) for block in cut[n]]) for n in some])
        for n, scores in zip(some, found):
            out[n] = _kept(cut[n], scores)
    return out


def _kept(found: list[Block], scores: np.ndarray) -> str:
    return " ".join(block.text for block, score in zip(found, scores) if score >= CUT)


def extract(
    pages: DataFrame, id_column: str = "page_id", url_column: str = "url",
    html_column: str = "html", labeller: Labeller | None = None,
) -> DataFrame:
    """id, URL, text and its number of code points for each row."""
    model = labeller or trained()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            texts = main_texts(batch.column("html").to_pylist(), model)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(text) for text in texts], pa.int64())],
                ["id", "url", "text", "n_chars"],
            )

    rows = pages.select(
        F.col(id_column).cast("bigint").alias("id"), F.col(url_column).alias("url"),
        F.col(html_column).alias("html"),
    )
    read = rows.mapInArrow(run, "id bigint, url string, text string, n_chars bigint")
    return read.withColumnsRenamed({"id": id_column, "url": url_column})
