"""The published queries over the curated and tutorial tables.

Each is a DataFrame function taking its input frames, so the same plan runs
on catalog tables, files or derived frames. The SQL text of each is kept next
to it for the SQL surface (``strata.operators.sqlsurface``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.dates import month_bucket

# ---------------------------------------------------------------------------
# The output names, groupings, orders and filter values of the
# seven queries below must equal those of the published queries; how each is
# computed and spelled is our own.
# ---------------------------------------------------------------------------


def cost_by_hospital(fato_consultas_procedimentos: DataFrame, dim_hospital: DataFrame) -> DataFrame:
    """Estimated cost per hospital and city, highest first.

    The fact's hospital id is text; it is cast to int for the join, so rows
    whose id is NULL or not a number drop out of the inner join.
    """
    f = fato_consultas_procedimentos
    h = dim_hospital
    return (
        f.join(h, f.id_hospital.try_cast("int") == h.id_hospital, "inner")
        .groupBy(h.nome, h.cidade)
        .agg(F.sum(f.custo_estimado).alias("total_custos"))
        .select(F.col("nome").alias("hospital"), "cidade", "total_custos")
        .orderBy(F.col("total_custos").desc_nulls_last())
    )


def events_by_month(fato_exames_receitas: DataFrame) -> DataFrame:
    """Number of exam / prescription events per month and event type."""
    return (
        # grouped by date; one text per month is formatted, not one per row
        fato_exames_receitas.groupBy(F.trunc("data", "MM").alias("mes"), "tipo_evento")
        .agg(F.count(F.lit(1)).alias("total_eventos"))
        .withColumn("mes", month_bucket("mes"))
        .orderBy(F.col("mes").asc_nulls_last(), F.col("tipo_evento").asc_nulls_last())
    )


def cost_by_procedure(fato_consultas_procedimentos: DataFrame) -> DataFrame:
    """Count and mean estimated cost per procedure; NULL is its own group."""
    return (
        fato_consultas_procedimentos.groupBy("procedimento")
        .agg(
            F.count(F.lit(1)).alias("total_procedimentos"),
            F.avg("custo_estimado").alias("custo_medio"),
        )
        .orderBy(F.col("custo_medio").desc_nulls_last())
    )


def insured(procedures: DataFrame) -> DataFrame:
    """Procedures whose insurance flag is exactly 'yes' or 'no'."""
    return procedures.filter(F.col("Insurance").isin("yes", "no"))


def balance(customers: DataFrame) -> DataFrame:
    """Customers with a non-negative balance."""
    return customers.filter(F.col("Balance") >= 0)


def insured_category(procedures: DataFrame, category: str) -> DataFrame:
    """Insured procedures of one category."""
    return procedures.filter((F.col("Category") == category) & (F.col("Insurance") == "yes"))


def vip_balance(customers: DataFrame, above: int = 200) -> DataFrame:
    """VIP customers with a balance above a threshold."""
    return customers.filter((F.col("Vip") == "yes") & (F.col("Balance") > above))


# SQL text of the three curated queries, written for Spark SQL over a
# namespace (the ``{ns}`` placeholder) so the SQL surface can run them as-is.
SQL = {
    "cost_by_hospital": """
        SELECT h.nome AS hospital, h.cidade, SUM(f.custo_estimado) AS total_custos
        FROM {ns}.fato_consultas_procedimentos f
        JOIN {ns}.dim_hospital h ON try_cast(f.id_hospital AS INT) = h.id_hospital
        GROUP BY h.nome, h.cidade
        ORDER BY total_custos DESC NULLS LAST""",
    "events_by_month": """
        SELECT date_format(data, 'yyyy-MM') AS mes, tipo_evento, COUNT(*) AS total_eventos
        FROM {ns}.fato_exames_receitas
        GROUP BY date_format(data, 'yyyy-MM'), tipo_evento
        ORDER BY mes NULLS LAST, tipo_evento NULLS LAST""",
    "cost_by_procedure": """
        SELECT procedimento, COUNT(*) AS total_procedimentos, AVG(custo_estimado) AS custo_medio
        FROM {ns}.fato_consultas_procedimentos
        GROUP BY procedimento
        ORDER BY custo_medio DESC NULLS LAST""",
    # tutorial queries over the customers / procedures tables (column names
    # resolve case-insensitively)
    "insured": "SELECT * FROM {ns}.procedures WHERE insurance = 'yes' OR insurance = 'no'",
    "balance": "SELECT * FROM {ns}.customers WHERE balance >= 0",
    "insured_category": "SELECT * FROM {ns}.procedures WHERE category = '{category}' AND insurance = 'yes'",
    "vip_balance": "SELECT * FROM {ns}.customers WHERE vip = 'yes' AND balance > {above}",
}
