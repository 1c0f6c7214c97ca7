"""Property tests: many generated cases, checked in one Spark job each."""
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aspectra.functions import arrays as arr
from aspectra.functions import text as tx

ids_lists = st.lists(st.lists(st.integers(1, 10_000), max_size=150), min_size=1, max_size=60)
prob_lists = st.lists(st.lists(st.floats(0, 1, allow_nan=False, width=32), min_size=4, max_size=4),
                      min_size=1, max_size=60)


@settings(max_examples=5, deadline=None)
@given(ids_lists)
def test_cut_pad_lengths(spark, cases):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i INT, ids ARRAY<INT>")
    out = df.select("i", tx.pad(tx.cut(F.col("ids"), 64, "head"), 64).alias("h"),
                    tx.pad(tx.cut(F.col("ids"), 100, "tail"), 100).alias("t")).collect()
    for r in out:
        c = cases[r.i]
        assert len(r.h) == 64 and r.h[:min(64, len(c))] == c[:64]
        assert len(r.t) == 100 and r.t[:min(100, len(c))] == c[-100:]


@settings(max_examples=5, deadline=None)
@given(prob_lists)
def test_argmax_matches_numpy(spark, cases):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i INT, p ARRAY<FLOAT>")
    for r in df.select("i", arr.argmax("p").alias("k")).collect():
        assert r.k == int(np.argmax(np.array(cases[r.i], np.float32)))


def test_missing_artefact_raises(scratch):
    from aspectra.operators.scoring import load_artefacts

    with pytest.raises(FileNotFoundError):
        load_artefacts(scratch + "/nope.json", scratch + "/nope.npz")
