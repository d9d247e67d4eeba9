"""Extra columns called like anything the operators use inside."""

import random

import public_tokenizers
import pytest
from gaugeworks.llm import interaction, jaccard, language, lines, mixing, personal, pieces, quality, ranked, tokencount, toxicity
from pyspark.sql import functions as F

from .conftest import prose

NAMES = ("row size s taken target source_size mix_place mix_goal goal_of_mix lines_that_go row_of_lines row_of_join copy_of_mix positions maybe block cells "
         "cell crowd name word words bits found feature seen base more same ids inst pattern term tf n rank score key part mask line position h x at "
         "failed kept severity grade toxic of_toxicity decoded of_pieces n_tokens component component_id token np pivot q item_id").split()


@pytest.fixture
def crowded(spark, tmp_path):

    rng = random.Random(7)
    rows = [(k, prose(rng, 30) + "\nsame long line in every document of these\nmail a@b.cc", "en", "a", 9) for k in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    df = df.select("*", *(F.lit("kept as it is").alias(c) for c in NAMES))
    df.write.parquet(str(tmp_path / "documents"))
    return spark.read.parquet(str(tmp_path / "documents"))


def test_no_name_clashes(spark, crowded):
    model, vocabulary = (public_tokenizers.path(x) for x in ("piece_bpe_32k.model", "byte_bpe_50k.json"))
    labels = spark.createDataFrame([(k, k % 2, k % 2) for k in range(12)], "doc_id long, quality int, toxic int")
    items = crowded.limit(2).withColumn("item_id", F.col("doc_id"))
    own = [mixing.mix(crowded), mixing.repeated(crowded), toxicity.toxicity(crowded, labels), pieces.both_ways(crowded, model),
           lines.deduplicated(crowded, lines.ANY), jaccard.deduplicated(crowded), tokencount.counted(crowded, vocabulary, 512)]
    for out in own:  # these keep the table's columns, values and all
        assert set(crowded.columns) <= set(out.columns)
        kept = out.select(*NAMES).distinct().collect()
        assert kept and all(set(r) == {"kept as it is"} for r in kept)
    assert quality.quality(crowded).count() == 12 and language.scored(crowded).count() == 12
    assert jaccard.linked(crowded).count() == 12 and lines.counted(crowded).count() == 12
    assert interaction.audit(crowded, labels).count() == 600
    assert sum(r.n_email for r in personal.personal(crowded).collect()) == 12
    assert ranked.search(crowded, items).count() == 24
