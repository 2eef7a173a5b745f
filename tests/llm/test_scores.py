import inspect

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimloom.llm import quality_gam as Q
from claimloom.llm import toxicity as T
from claimloom.llm.text import table

FOLDER = "/root/testdata/sf0.01"


def area(scored, labels, column):
    rows = scored.join(labels, "doc_id").where(f"{column} is not null").select("score", column).collect()
    good = np.array([r.score for r in rows if r[1]])
    bad = np.array([r.score for r in rows if not r[1]])
    return (good[:, None] > bad).mean() + 0.5 * (good[:, None] == bad).mean()


def held_out_area(spark, score, column, parts, part):
    docs, labels = table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels")
    held_out = Q.id_remainder(F.col("doc_id"), parts) == part
    scored = score(docs, labels, held_out)
    assert scored.count() == docs.count()
    return area(scored, labels.where(held_out), column)


def test_quality_of_held_out_rows(spark):
    assert held_out_area(spark, Q.score_quality, "quality", 5, 0) > 0.95


def test_toxicity_of_held_out_rows(spark):
    assert held_out_area(spark, T.score_toxicity, "toxic", 4, 2) > 0.8


def test_toxicity_learns_from_40000_rows():
    assert T.MAX_TRAINING_ROWS == 40_000
    assert all(inspect.signature(f).parameters["max_rows"].default == 40_000 for f in (T.learn, T.score_toxicity))


@pytest.mark.parametrize(("score", "column"), [(Q.score_quality, "quality"), (T.score_toxicity, "toxic")])
def test_edges(spark, edge, nothing, score, column):
    some = [(1, 1), (2, 0), (6, 0), (None, 1), (3, None), (99, 1), (1, 1)]
    for rows in (some, [(1, 1)], []):
        labels = spark.createDataFrame(rows, f"doc_id bigint, {column} int")
        got = score(edge, labels).collect()
        assert len(got) == edge.count()
        assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
        assert len({r.score for r in got if r.doc_id in (3, 4)}) == 1
    assert score(nothing, labels).count() == 0


def test_scores_do_not_look_at_other_columns(spark, small):
    labels = table(spark, "/root/testdata/sf0.001", "labels")
    once = {r.doc_id: r.score for r in Q.score_quality(small, labels).collect()}
    other = small.withColumns({"lang": F.lit("x"), "source": F.lit("y"), "n_chars": F.lit(0)})
    assert once == {r.doc_id: r.score for r in Q.score_quality(other.repartition(5), labels).collect()}


def test_tables_add_up():
    rng = np.random.default_rng(0)
    x = rng.random((4000, len(Q.FEATURES)))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)  # no single feature tells anything
    model = Q.fit(x, y)
    assert (0, 1) in model.pairs or (1, 0) in model.pairs
    assert ((model.score(x) > 0.5) == y).mean() > 0.95
    again = model.intercept + sum(t[np.searchsorted(e, x[7, j], side="right")] for j, (e, t) in enumerate(zip(model.edges, model.tables)))
    again += sum(
        t[tuple(np.searchsorted(model.pair_edges[k], x[7, k], side="right") for k in p)] for p, t in zip(model.pairs, model.pair_tables)
    )
    assert np.isclose(1 / (1 + np.exp(-again)), model.score(x[7:8])[0])


@pytest.fixture(scope="module")
def restorer(spark):
    docs = table(spark, FOLDER, "documents").union(
        table(spark, FOLDER, "documents").limit(50).withColumn("text", F.lit("idiot loser moron scum worthless stupid pathetic trash"))
    )
    return T.Restorer(T.character_model(docs))


@pytest.mark.parametrize(
    ("written", "meant"),
    [
        ("1d10t", "idiot"), ("i d i o t", "idiot"), ("idiooooot", "idiot"), ("i-d-i-o-t!", "idiot"), ("$tupid", "stupid"), ("m0r0n,", "moron"),
        ("tr@sh!!!", "trash"), ("p4th3t1c", "pathetic"), ("the&&&", "the"), ("lo$er", "loser"), ("STUPID.", "stupid"), ("2024", ""),
        ("w o r t h l e s s  s c u m", "worthless scum"),
    ],
)
def test_restored_spelling(restorer, written, meant):
    assert " ".join(restorer.words(written)) == meant


@pytest.fixture(scope="module")
def coarse(spark):
    docs = table(spark, FOLDER, "documents").select("text")
    said = docs.limit(400).withColumn("text", F.lit("you stupid ass what shit such an idiot"))
    return T.Restorer(T.character_model(docs.union(said)))


@pytest.mark.parametrize(
    ("written", "meant"),
    [
        ("a$$", "ass"), ("@$$", "ass"), ("@ss!", "ass"), ("$$tupid", "stupid"), ("$#!7", "shit"), ("$#!7!!!", "shit"), ("i - d - i - o - t", "idiot"),
        ("i . d . i . o . t", "idiot"), ("$ # ! 7", "shit"), ("the***", "the"), ("THE!!", "the"), ("is%%%", "is"), ("with###", "with"),
        ("$2,000.50", ""), ("50%", ""), ("1 2 3 4", ""), ("+1", ""), ("| | | |", ""), ("--- ...", ""), ("***", ""), ("$$$", ""),
    ],
)
def test_stand_ins_at_the_edges(coarse, written, meant):
    assert " ".join(coarse.words(written)) == meant


def test_lattice_paths_are_all_weighed(restorer):
    """The decoder finds what trying every path finds."""
    from itertools import product

    for token in ("1d1o7", "sc*m", "mor00n"):
        steps = T.lattice(token)
        best = max(
            (sum(c for _, c in path) + T.word_score("".join(x for x, _ in path), restorer.model), "".join(x for x, _ in path))
            for path in product(*steps)
        )
        assert T.viterbi(steps, restorer.model) == best[1]


def test_character_counts(spark):
    assert T.letter_counts([b"abc"]).sum() == 6  # three borders, three letters, three borders again
    assert T.letter_counts([]).sum() == 0 and T.letter_counts([None, b""]).sum() >= 0


def test_restored_column(edge):
    got = T.restore(edge.drop("restored"), T.character_model(edge)).collect()
    assert {r.restored for r in got if r.doc_id == 8} == {"short text"}
