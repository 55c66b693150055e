"""Main text of web pages: a bidirectional LSTM in numpy labels every leaf block of a page as part of the article or not.

A page becomes the sequence of its leaf blocks (``html_blocks``). A block's vector holds hashed names, classes and ids of all elements around it,
its hashed words, and measures of its shape and place; the network reads the sequence in both directions, so a block is classified with the
whole document as context. It is fitted here, to TRAINING_PAGES pages of invented layouts (``page_layouts``), which is the bound of the
sample; the fit depends on nothing else, so all runs label alike. The table's own pages are only labelled.

Defined results: a null or empty html, or one without text, has an empty text; repeated rows are labelled alike; a block's score that ties at
zero counts as not in the article; pages are read whole, however long (beyond SEGMENT blocks in segments, with states for each block); white
space is what Unicode counts as such, no-break spaces too; an empty table gives an empty result. Columns other than the three named are never
read, so their names are free.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from marketlake.llm import lstm, page_layouts
from marketlake.llm.html_blocks import Blocks, features

TRAINING_PAGES, HIDDEN, EPOCHS = 1500, 24, 12
SEGMENT = 2048
#: Blocks that are labelled together, over several pages.
TOGETHER = 4096


def labelled_page(seed: int) -> tuple[Blocks, np.ndarray]:
    """The blocks of an invented page without their marks, and whether each is in the article."""
    blocks = Blocks(page_layouts.Page(seed).html)
    labels = np.array([page_layouts.MARK in t for t in blocks.texts], np.float32)
    blocks.texts = [t.replace(page_layouts.MARK, "") or "." for t in blocks.texts]
    return blocks, labels


@lru_cache(maxsize=4)
def model(pages: int = TRAINING_PAGES, hidden: int = HIDDEN, epochs: int = EPOCHS) -> lstm.Params:
    pairs = [labelled_page(seed) for seed in range(pages)]
    pairs = [(b, y) for b, y in pairs if len(y)]
    return lstm.train([features(b) for b, _ in pairs], [y for _, y in pairs], hidden, epochs)


def label(params: lstm.Params, pages: list[Blocks]) -> list[np.ndarray]:
    """For each page whether its blocks are in the article; pages of like length are labelled together."""
    out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
    order = sorted((k for k in range(len(pages)) if pages[k].texts), key=lambda k: len(pages[k].texts))
    while order:
        longest = len(pages[order[-1]].texts)
        if longest > SEGMENT:
            k = order.pop()
            found = lstm.long_scores(params, lambda a, b, p=pages[k]: features(p, a, b), longest, SEGMENT)
            out[k] = found > 0
            continue
        group, order = order[-max(1, TOGETHER // longest) :], order[: -max(1, TOGETHER // longest)]
        for k, found in zip(group, lstm.scores(params, [features(pages[k]) for k in group]), strict=True):
            out[k] = found > 0
    return out


def main_text(blocks: Blocks, kept: np.ndarray) -> str:
    return " ".join(t for t, k in zip(blocks.texts, kept, strict=True) if k)


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", params: lstm.Params | None = None) -> DataFrame:
    """Per page: ``page_id, url, text, n_chars, n_blocks, n_main_blocks``."""
    params = params or model()
    rows = pages.select(pages[id_col].alias("page_id"), pages[url_col].alias("url"), pages[html_col].alias("html"))
    schema = T.StructType([rows.schema["page_id"], rows.schema["url"]]).add("text", "string").add("n_chars", "long")
    schema = schema.add("n_blocks", "integer").add("n_main_blocks", "integer")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                read = [Blocks(h.as_py() or "") for h in batch.column("html")]
                kept = label(params, read)
                texts = [main_text(b, k) for b, k in zip(read, kept, strict=True)]
                columns = [
                    batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([len(b.texts) for b in read], pa.int32()), pa.array([int(k.sum()) for k in kept], pa.int32()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(run, schema)
