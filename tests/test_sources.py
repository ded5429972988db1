import os

from strata.sources import catalog as C
from strata.sources.files import create_text_table, read_csv, read_delimited, read_parquet_dir
from strata.sources.jdbc import extract_to_parquet, read_jdbc, write_jdbc
from strata.sources.sinks import publish_outcomes, write_result_files

CUSTOMERS = "Cust_Id int, Customer string, Balance int, Past_Due int, Vip string"


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_csv_header_inferred(spark, scratch):
    write(f"{scratch}/c/hospitais.csv", "id_hospital,nome,cidade,estado\n1,H1,Rio,RJ\n2,H2,SP,SP\n")
    df = read_csv(spark, f"{scratch}/c/hospitais.csv")
    assert dict(df.dtypes)["id_hospital"] == "int" and df.count() == 2


def test_delimited_declared_schema_mixed_location(spark, scratch):
    """Both tutorial files in one folder, headers not skipped: the other
    table's rows and the header lines come back with NULLs, never an error."""
    write(f"{scratch}/mixed/customers.csv", "Cust_Id,Customer,Balance,Past_Due,Vip\n1,Ann,200,0,yes\n2,Bob,-1,0,no\n")
    write(f"{scratch}/mixed/procedures.csv",
          "Procedure_Id,Procedure,Category,Price,Duration,Insurance,Customer_Id\nP1,Scan,imagem,100,30,yes,1\n")
    df = read_delimited(spark, f"{scratch}/mixed", CUSTOMERS)
    assert df.count() == 5
    assert df.filter("Balance >= 0").count() == 1  # only Ann; headers/other rows have NULL balance
    t = create_text_table(spark, "default.customers_txt", CUSTOMERS, f"{scratch}/mixed")
    assert t.filter("Vip = 'yes' AND Balance > 100").count() == 1


def test_jdbc_roundtrip_derby(spark, scratch):
    url = "jdbc:derby:memory:strata_test;create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    df = spark.createDataFrame([(i, f"h{i}") for i in range(1, 51)], "ID_HOSPITAL int, NOME string")
    write_jdbc(df, url, "HOSPITAIS", props, mode="overwrite")
    back = read_jdbc(spark, url, "HOSPITAIS", props, partition_column="ID_HOSPITAL", num_partitions=4)
    assert back.rdd.getNumPartitions() == 4 and back.count() == 50
    paths = extract_to_parquet(spark, url, ["HOSPITAIS"], f"{scratch}/raw", props, {"HOSPITAIS": "ID_HOSPITAL"})
    assert read_parquet_dir(spark, f"{scratch}/raw", "hospitais").count() == 50
    assert paths["hospitais"].endswith("/hospitais")


def test_catalog_helpers(spark, scratch):
    df = spark.createDataFrame([(1, "a")], "id int, nome string")
    df.write.parquet(f"{scratch}/disc/dim_a")
    C.discover(spark, "discns", f"{scratch}/disc", ["dim_a"], prefix="raw_")
    assert spark.table("discns.raw_dim_a").count() == 1
    C.create_table_from_df(spark, df, "discns.made", comment="made from a frame")
    C.comment_table(spark, "discns.made", "documented", {"id": "the key"})
    layer = {r.table: r for r in C.describe_layer(spark, "discns").collect()}
    assert layer["made"].description == "documented" and "id int" in layer["made"].columns


def test_result_files_and_outcome_publish(spark, scratch):
    df = spark.createDataFrame([(1, "a")], "id int, nome string")
    path = write_result_files(df, f"{scratch}/results", "run-1")
    assert spark.read.csv(path, header=True).count() == 1
    out = spark.createDataFrame([("ctx", "t", "Passed")], "context string, table string, outcome string")
    publish_outcomes(out, f"{scratch}/dq")
    publish_outcomes(out, f"{scratch}/dq")
    assert spark.read.json(f"{scratch}/dq").count() == 2
