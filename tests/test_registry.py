"""Every registered query against its SQL on the smallest tables, and the shape of their plans."""

import os

import pytest

from checks import registry
from checks.compare import difference, oracle
from tests.conftest import plan_of

SF = os.environ.get("QUIRE_TEST_SF", "/root/testdata/sf0.001")
# write zstd test files, which Spark cannot do itself; the second reads them by a Python data source
PYTHON_ALLOWED = {"S02_zstd_lines", "S02_seekable_lines"}


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(SF):
        pytest.skip(f"no tables at {SF}")
    return oracle(SF)


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.SQL)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_agrees_with_sql(spark, con, name):
    df = registry.QUERIES[name](spark, SF)
    assert difference(df, con, registry.SQL[name]) is None
    text = plan_of(df)
    if name not in PYTHON_ALLOWED:
        assert "Python" not in text and "InPandas" not in text
    assert "CartesianProduct" not in text


def test_scans_read_only_what_they_use(spark):
    text = plan_of(registry.QUERIES["Q01_cover_sources"](spark, SF), "formatted")
    assert "ReadSchema: struct<doc_id:bigint,source:string>" in text


def test_share_reuses_the_counted_rows(spark):
    df = registry.QUERIES["Q06_access_types"](spark, SF)
    df.collect()
    assert "ReusedExchange" in plan_of(df)


def test_edition_pairs_are_shuffled_on_both_columns(spark):
    text = plan_of(registry.QUERIES["Q13_edition_variations"](spark, SF))
    assert "hashpartitioning(main_edition" in text and "variation" in text.split("hashpartitioning(main_edition")[1][:60]


def test_scratch_tables_go_to_the_shared_folder():
    from types import SimpleNamespace

    from quire.session import scratch_path

    def session(**settings):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: settings.get(k.split(".")[-1], d)))

    assert scratch_path(session(dir="hdfs://c/shared/", master="yarn"), "t").startswith("hdfs://c/shared/quire/t-")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(session(master="yarn"), "t")
