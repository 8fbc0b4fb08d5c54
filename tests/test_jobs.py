from __future__ import annotations

import pytest

from ledgerlake import jobs
from ledgerlake.plans import finance
from ledgerlake.sinks import publish
from ledgerlake.sources.relational import READ_ONLY_UTC, JdbcSource, UnknownTable
from tests import finance_lake as lakes
from tests.conftest import rows
from tests.test_finance import ordered, send
from tests.test_streaming import Reader


@pytest.fixture(scope="module")
def lake():
    return lakes.build()


def test_jobs_layer_by_layer(spark, folder, lake, capsys):
    send(spark, f"{folder}/topics", lake)
    base = ["--lake", f"{folder}/lake", "--prefix", "lake."]
    assert jobs.main(["land", *base, "--messages", f"{folder}/topics"]) == jobs.DONE
    for layer in ("state", "curated", "outliers"):
        assert jobs.main([layer, *base]) == jobs.DONE
    assert jobs.main(["plan", *base]) == jobs.DONE
    assert "gasto_por_tipo_mensual" in capsys.readouterr().out
    assert jobs.main(["publish", *base]) == jobs.SKIPPED
    assert jobs.main(["publish", *base, "--published", f"{folder}/out"]) == jobs.DONE
    found = publish.read_published(spark, f"{folder}/out", "balance_mensual")
    assert rows(found) == ordered(lakes.balance(lake))
    assert jobs.main(["load", *base]) == jobs.SKIPPED
    assert jobs.main(["load", *base, "--published", f"{folder}/out", "--dataset", "bad-name"]) == jobs.FAILED
    spark.sql(f"CREATE DATABASE marts_of_jobs LOCATION '{folder}/marts'")
    assert jobs.main(["load", *base, "--published", f"{folder}/out", "--dataset", "marts_of_jobs"]) == jobs.DONE
    assert spark.table("marts_of_jobs.anomalias").count() == len(lakes.high_amounts(lake))
    spark.sql("DROP DATABASE marts_of_jobs CASCADE")
    assert jobs.main(["expire", *base, "--published", f"{folder}/out"]) == jobs.SKIPPED
    assert jobs.main(["publish", *base, "--published", f"{folder}/out"]) == jobs.DONE
    assert jobs.main(["expire", *base, "--published", f"{folder}/out", "--keep", "1", "--days", "0"]) == jobs.DONE

    # The source holds what the lake does, then an inflow more.
    assert jobs.main(["reconcile", *base]) == jobs.SKIPPED
    for name in finance.SOURCE:
        spark.read.parquet(f"{folder}/lake/state/{name}").drop(*finance.LINEAGE).write.parquet(f"{folder}/source/{name}")
    assert jobs.main(["reconcile", *base, "--source", f"{folder}/source"]) == jobs.DONE
    again = spark.read.parquet(f"{folder}/lake/state/ingresos").drop(*finance.LINEAGE).filter("eliminado_en IS NULL").limit(1)
    again.write.mode("append").parquet(f"{folder}/source/ingresos")
    capsys.readouterr()
    assert jobs.main(["reconcile", *base, "--source", f"{folder}/source"]) == jobs.FAILED
    said = capsys.readouterr().err
    assert "row count on ingresos" in said and "source totals on balance_mensual.ingresos" in said

    assert jobs.main(["profile", *base]) == jobs.DONE
    assert jobs.main(["summary", *base]) == jobs.DONE
    assert "75000.00" in capsys.readouterr().out


def test_nothing_to_land(spark, folder):
    assert jobs.main(["land", "--lake", folder]) == jobs.SKIPPED


def test_a_failed_gate_is_exit_code_one(spark, folder, lake, capsys):
    send(spark, f"{folder}/topics", {**lake, "metas": []})
    base = ["--lake", f"{folder}/lake", "--prefix", "lake.", "--messages", f"{folder}/topics"]
    assert jobs.main(["daily", *base]) == jobs.FAILED
    assert "state on metas" in capsys.readouterr().err


def test_jdbc_reads_only_listed_tables_in_parallel():
    class Session:
        read = Reader()

    def options(self, **values):
        self.settings.update(values)
        return self

    Reader.options = options
    source = JdbcSource(
        Session(), "jdbc:mysql://db/lake", tuple(finance.SOURCE), {"user": "reader"}, {"egresos": ("id", 0, 10**9, 64)}
    )
    assert source.table("egresos") == {
        "format": "jdbc", "url": "jdbc:mysql://db/lake", "dbtable": "egresos", "user": "reader",
        "sessionInitStatement": READ_ONLY_UTC, "fetchsize": 10_000,
        "partitionColumn": "id", "lowerBound": 0, "upperBound": 10**9, "numPartitions": 64,
    }
    for read in (source.table, source.row_count, lambda name: source.monthly_totals(name, "u", "s", "m", "d")):
        with pytest.raises(UnknownTable):
            read("auth_tokens")


def test_jdbc_sums_are_pushed_to_the_source():
    class Session:
        read = Reader()

    def options(self, **values):
        self.settings.update(values)
        return self

    Reader.options = options
    source = JdbcSource(Session(), "jdbc:mysql://db/lake", ("ingresos",))
    sent = source.monthly_totals("ingresos", "usuario_id", "fecha_inicio", "monto", "eliminado_en")
    assert "dbtable" not in sent and sent["sessionInitStatement"] == READ_ONLY_UTC
    month = "DATE_ADD(CAST(fecha_inicio AS DATE), INTERVAL 1 - DAYOFMONTH(CAST(fecha_inicio AS DATE)) DAY)"
    assert sent["query"] == (
        f"SELECT usuario_id AS entity, {month} AS period, SUM(monto) AS total, COUNT(*) AS n FROM ingresos "
        f"WHERE eliminado_en IS NULL GROUP BY usuario_id, {month}"
    )
    assert source.row_count("ingresos")["query"] == "SELECT 'ingresos' AS `table`, COUNT(*) AS n FROM ingresos"
