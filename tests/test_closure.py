import pytest

from corpusloom.operators import loading


def test_closure_is_whole_or_fails(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    chain = spark.createDataFrame([(i, i + 1) for i in range(4)], "src long, dst long")
    start = spark.createDataFrame([(0,)], "node long")
    assert {(r.node, r.depth) for r in loading.closure(chain, start, 6).collect()} == {(i, i) for i in range(5)}
    with pytest.raises(RuntimeError):
        loading.closure(chain, start, 3)
