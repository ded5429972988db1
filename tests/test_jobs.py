"""The command-line jobs end to end: CSV -> JDBC (Derby) -> raw Parquet ->
staged -> curated -> rules -> SQL."""

import os
import shutil

from strata.plans import standins as S
from strata.plans.jobs import main
from tests.conftest import SF_SMALL

DERBY = ["--jdbc-url", "jdbc:derby:memory:strata_jobs;create=true",
         "--jdbc-driver", "org.apache.derby.jdbc.EmbeddedDriver"]


def test_jobs_end_to_end(spark, scratch):
    tables = ["hospitais", "consultas"]
    raw = S.raw_tables(spark, SF_SMALL)
    for t in tables:
        raw[t].coalesce(1).write.option("header", True).csv(f"{scratch}/csvdir/{t}")
        part = [f for f in os.listdir(f"{scratch}/csvdir/{t}") if f.endswith(".csv")][0]
        shutil.copy(f"{scratch}/csvdir/{t}/{part}", f"{scratch}/{t}.csv")
    main(["seed", "--csv-root", scratch, *DERBY, "--tables", *tables], spark)
    out = main(["extract", "--raw-root", f"{scratch}/raw", *DERBY, "--tables", *[t.upper() for t in tables]], spark)
    assert set(out) == set(tables)
    main(["stage", "--raw-root", f"{scratch}/raw", "--namespace", "jobs_staged", "--root", f"{scratch}/w",
          "--table", "hospitais"], spark)
    staged = spark.table("jobs_staged.hospitais")
    assert staged.count() == raw["hospitais"].count()
    assert dict(staged.dtypes)["id_hospital"] == "int"
    res = main(["sql", "--query", "SELECT count(*) AS n FROM jobs_staged.hospitais"], spark)
    assert res["status"] == 200 and res["rows"] == [{"n": staged.count()}]
    refused = main(["sql", "--query", "DROP TABLE jobs_staged.hospitais"], spark)
    assert refused["status"] == 400 and spark.catalog.tableExists("jobs_staged.hospitais")


def test_jobs_curate_and_quality(spark, scratch):
    for name, df in S.raw_tables(spark, SF_SMALL).items():
        df.write.parquet(f"{scratch}/raw/{name}")
    main(["stage", "--raw-root", f"{scratch}/raw", "--namespace", "jobs_st", "--root", f"{scratch}/w"], spark)
    out = main(["curate", "--staged", "jobs_st", "--curated", "jobs_cur", "--root", f"{scratch}/w"], spark)
    assert set(out) == {"dim_hospital", "dim_profissional", "fato_consultas_procedimentos", "fato_exames_receitas"}
    res = main(["quality", "--curated", "jobs_cur", "--results-root", f"{scratch}/dq", "--as-of", "1990-01-01"], spark)
    assert res["rules"] == 83
    # with as_of before every event, the future-date rules fail
    assert any("data_evento > current_date" in f for f in res["failed"])
