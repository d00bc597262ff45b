"""The pipeline against the chain of brute-force versions of its stages, and over odd tables."""
import collections
import random

import pytest

import corpus_pipeline
from helixframe.llm import quality

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def texts():
    rng = random.Random(12)
    vocabulary = [f"word{k}" for k in range(3000)] + ["the", "of", "and", "is"] * 200
    prose = lambda n: ". ".join(" ".join(rng.choice(vocabulary) for _ in range(12)) for _ in range(n // 12)) + "."
    out = [prose(rng.choice([72, 120, 240])) for _ in range(40)]
    out += [out[3], out[3] + " more", out[7].replace("the", "a", 1), None, "", "short text", "# * " * 80, "same words again " * 60, prose(3000)]
    return list(enumerate(out))


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("corpus"))
    given = texts()
    rows = [(i, t, "en", "s", len(t or "")) for i, t in given]
    spark.createDataFrame(rows, SCHEMA).repartition(2).write.parquet(f"{folder}/documents.parquet")
    item = " ".join(given[5][1].split()[10:40])
    spark.createDataFrame([(1, item), (2, None), (3, "nothing that is in any of the texts")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, given, item


def test_stages_like_brute_force(spark, tables):
    folder, given, item = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    good = {r["doc_id"] for r in quality.quality_rules(docs).collect() if r["kept"]}
    left = [(i, t) for i, t in given if i in good]
    assert 30 < len(left) < len(given)  # junk goes, prose stays
    label = {i: i for i, _ in left}

    def find(k):
        return k if label[k] == k else find(label[k])

    for a, x in left:
        for b, y in left:
            p, q = shingles(x), shingles(y)
            if a < b and 100 * len(p & q) >= 80 * len(p | q):
                label[max(find(a), find(b))] = min(find(a), find(b))
    left = [(i, t) for i, t in left if find(i) == i]
    own = shingles(item)
    expected = {i for i, t in left if 100 * len(own & shingles(t)) < 80 * len(own)}
    assert 5 not in expected and len(expected) == len(left) - 1
    found = corpus_pipeline.run(spark, folder).collect()
    assert collections.Counter(r["doc_id"] for r in found) == collections.Counter(expected)
    assert all(r["n_pieces"] == len(r["ids"]) > 0 for r in found)


def test_empty_table(spark, tables, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{tables[0]}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_vote_patterns_are_counted_without_running_the_features_again(spark):
    """A filter below the counts would be pushed under the projection that splits texts."""
    votes = quality.quality_votes(quality.quality_features(spark.createDataFrame([(1, "a b c. " * 30)], "doc_id long, text string"), ["doc_id"]))
    plan = votes.groupBy("pattern", "base_failed").count()._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter" not in plan
    assert quality.posterior_table(votes).count() <= 1
