import numpy as np

from lakeops.ml import network


def test_network_leaves_out_what_does_not_fit(spark, tmp_path):
    rng = np.random.default_rng(1)
    layers = [(rng.normal(size=(3, 4)), rng.normal(size=4)), (rng.normal(size=(4, 2)), rng.normal(size=2))]
    network.save_layers(spark, layers, str(tmp_path / "net"))
    given = [(1, [1.0, 2.0, 3.0]), (2, None), (3, [1.0, None, 3.0]), (4, [1.0]), (5, [-5.0, 0.0, 2.0])]
    df = spark.createDataFrame(given, "id int, x array<double>")
    got = {r["id"]: r for r in network.predict(df, str(tmp_path / "net"), 3, "x").collect()}
    assert [i for i, r in got.items() if r["probability"] is None and r["pred_class"] is None] == [2, 3, 4]
    want = network.forward(layers, np.array([given[0][1], given[4][1]]))
    np.testing.assert_allclose([got[1]["probability"], got[5]["probability"]], want)
    assert [got[i]["pred_class"] for i in (1, 5)] == want.argmax(axis=1).tolist()
    assert network.predict(df.limit(0), str(tmp_path / "net"), 3, "x").count() == 0
