"""The stages, each on what the one before kept."""

import re
from pathlib import Path

import corpus_pipeline
import pytest
from gaugeworks.llm import queries

from .conftest import words

SMALL = "/root/testdata/sf0.001"


@pytest.mark.skipif(not Path(SMALL).exists(), reason="the given tables are not here")
def test_pipeline(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, kept = docs.columns, []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SMALL).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if k < 4:
            assert docs.columns == columns
        kept.append(docs.count())
    assert kept[0] >= kept[1] >= kept[2] > 0
    assert docs.filter("NOT round_trip").count() == 0
    # No two texts left by the join are near copies.
    texts = [r.text for r in spark.read.parquet(str(tmp_path / "near_copies")).collect()]
    sets = [{tuple(w[k:k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set()) for w in map(words, texts)]
    for i, a in enumerate(sets):
        for b in sets[:i]:
            assert not a or 100 * len(a & b) < 75 * len(a | b)
    # No long line stands twice after the second stage.
    lines = [x for r in spark.read.parquet(str(tmp_path / "line_dedup")).collect() for x in (r.text or "").split("\n") if len(x) >= 24]
    assert len(lines) == len(set(lines))


def test_one_query_for_each_operator():
    assert sorted(int(re.match(r"op(\d+)_", x)[1]) for x in queries.QUERIES) == list(range(1, 14))
