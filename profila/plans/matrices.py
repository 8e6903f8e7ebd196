"""The feature matrices the stack learners read (T5).

``app_tag_matrix``  counts + tf-idf of the app list and of the tag list over
                    distinct (device, app, tag list) triples — the gender
                    and age stacks' input.
``active_matrix``   counts + tf-idf of 1–3-grams of the date-ordered
                    active-app list — the active-app gender stack's input.

Every device of ``devs`` is a document (one without events is empty), so
``n`` in the idf is the device count.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from ..operators import lists as L
from ..operators import text as TX
from ..operators.vectors import block_matrix, count_tfidf_blocks, matrix_vocabulary, to_vectors
from ..session import durable


@dataclass
class Matrix:
    cells: DataFrame      # (device_id, col, value)
    n_cols: object        # V, the matrix width (a scalar-subquery Column)
    rows: DataFrame       # (device_id) — every document, also empty ones

    def materialize(self) -> "Matrix":
        """Write the cells once (reliable checkpoint in the cluster's
        checkpoint folder): every stack learner and k-means reads the same
        matrix, so it is computed once and its lineage is cut."""
        ensure_checkpoint_dir(self.cells.sparkSession)
        cells = durable(self.cells)
        rows = durable(self.rows)
        width = cells.select("col").distinct().count()
        return Matrix(cells, width, rows)

    def vectors(self, base: DataFrame | None = None, out: str = "features") -> DataFrame:
        vocab = matrix_vocabulary(self.cells)
        return to_vectors(self.cells, vocab, self.n_cols, base if base is not None else self.rows, out=out)


def _width(cells: DataFrame):
    """Matrix width as a scalar subquery: stays inside the lazy plan."""
    return cells.select("col").distinct().agg(F.count(F.lit(1))).scalar()


def _n_rows(rows: DataFrame):
    return rows.agg(F.count(F.lit(1))).scalar()


def app_tag_matrix(events: DataFrame, devs: DataFrame) -> Matrix:
    rows = devs.select("device_id").distinct()
    n = _n_rows(rows)
    triples = L.distinct_app_tags(events)
    tf_app = TX.term_counts(triples, "device_id", F.col("app_id").cast("string"))
    tf_tag = TX.term_counts(triples, "device_id", "tag_list")
    blocks = count_tfidf_blocks(tf_app, "app", n) + count_tfidf_blocks(tf_tag, "tag", n)
    cells = block_matrix(blocks)
    return Matrix(cells, _width(cells), rows)


def active_matrix(events: DataFrame, devs: DataFrame, n_max: int = 3) -> Matrix:
    from .queries import active_terms
    rows = devs.select("device_id").distinct()
    n = _n_rows(rows)
    tf = TX.term_counts_of_terms(active_terms(events, devs, n_max), "device_id")
    cells = block_matrix(count_tfidf_blocks(tf, "act", n))
    return Matrix(cells, _width(cells), rows)
