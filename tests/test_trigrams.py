"""Search through character sequences against a plain ILIKE."""

import pytest

from millrace.operators import trigrams

NAMES = [
    "Three Gorges", "three gorges II", "Grand Coulée", "GRAND COULÉE 2", "50% Solar", "50_ Solar", "50x Solar", "a", "", None,
    "back\\slash", "aaaa", "ring ring", "Straße", "İzmir", "日本発電所", "tab\tbed",
]
PATTERNS = [
    "%gorges%", "%GORGES", "three%", "%coulée%", "50\\% sol%", "50\\_%", "50_ sol%", "%", "", "a", "%a%", "ab", "%aaa%", "%k\\\\s%",
    "%ring%ring%", "%three%gorges%ii%", "%日本発%", "%電所", "%xyz%", "straße", "%stras%", "%i̇zm%", "_ree gor%", "%\tbed", "%gor__s%",
]


@pytest.fixture(scope="module")
def names(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("trigrams"))
    df = spark.createDataFrame([(i, n) for i, n in enumerate(NAMES)] + [(0, "other gorges")], "id bigint, name string")
    trigrams.build_trigrams(df, path)
    return df, path


def test_every_pattern(names):
    df, path = names
    for pattern in PATTERNS:
        found = sorted(map(str, trigrams.search_like(df, path, pattern).collect()))
        assert found == sorted(map(str, df.where(df.name.ilike(pattern)).collect())), pattern


def test_runs():
    assert trigrams.literal_runs("a%bc_d\\%e\\\\f") == ["a", "bc", "d%e\\f"]


def test_a_search_reads_its_lists_alone(names):
    df, path = names
    plan = trigrams.search_like(df, path, "%three gorges%")._jdf.queryExecution().executedPlan().toString()
    assert "In(gram, [" in plan
    assert trigrams.search_like(df, path, "%three gorgez%").count() == 0
