"""Hospital data model: seven staged tables and a four-table star schema.

Derivations are pure DataFrame -> DataFrame functions; reading and writing
are done by the callers (see ``strata.plans.workflow``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.joins import BROADCAST_ROWS, left_join_counted, times_in
from strata.operators.staging import ColumnSpec as C
from strata.operators.staging import StagingSpec

# ---------------------------------------------------------------------------
# Table names, keys, column names and types of the staged
# layer; the exam-type costs, the flat prescription cost and the event-type
# labels of the curated layer. They must equal the source system's for the
# curated tables and the published queries to mean the same thing.
# ---------------------------------------------------------------------------
STAGING_SPECS: dict[str, StagingSpec] = {
    "hospitais": StagingSpec(
        "hospitais",
        ("id_hospital",),
        (C("id_hospital", "int"), C("nome", "string"), C("cidade", "string"), C("estado", "string")),
        "drop",
        "Hospitals: one row per hospital.",
    ),
    "profissionais_saude": StagingSpec(
        "profissionais_saude",
        ("id_profissional",),
        (
            C("id_profissional", "int"),
            C("nome", "string"),
            C("especialidade", "string"),
            C("crm", "string"),
            C("hospital_id", "int"),
        ),
        "drop",
        "Health professionals and the hospital they work at.",
    ),
    "consultas": StagingSpec(
        "consultas",
        ("id_consulta",),
        (
            C("id_consulta", "int"),
            C("id_paciente", "int"),
            C("id_profissional", "int"),
            C("data_consulta", "date", "cast"),
            C("motivo", "string"),
            C("diagnostico", "string"),
        ),
        "drop",
        "Consultations of a patient with a professional.",
    ),
    "exames": StagingSpec(
        "exames",
        ("id_exame",),
        (
            C("id_exame", "int"),
            C("id_consulta", "int"),
            C("tipo", "string"),
            C("resultado", "string"),
            C("data", "date", "cast"),
        ),
        "drop",
        "Exams requested in a consultation.",
    ),
    "receitas": StagingSpec(
        "receitas",
        ("id_receita",),
        (
            C("id_receita", "int"),
            C("id_consulta", "int"),
            C("medicamento", "string"),
            C("dosagem", "string"),
            C("inicio", "date", "legacy"),
            C("fim", "date", "legacy"),
        ),
        "keep",
        "Prescriptions written in a consultation.",
    ),
    "internacoes": StagingSpec(
        "internacoes",
        ("id_internacao",),
        (
            C("id_internacao", "int"),
            C("id_paciente", "int"),
            C("id_hospital", "int"),
            C("motivo", "string"),
            C("data_entrada", "date", "legacy"),
            C("data_saida", "date", "legacy"),
        ),
        "keep",
        "Hospital admissions of a patient.",
    ),
    "procedimentos": StagingSpec(
        "procedimentos",
        ("id_procedimento",),
        (
            C("id_procedimento", "int"),
            C("id_paciente", "int"),
            C("tipo", "string"),
            C("data_procedimento", "date", "legacy"),
            C("hospital_id", "int"),
        ),
        "keep",
        "Procedures performed on a patient at a hospital.",
    ),
}

EXAM_COSTS = {"sangue": 100.0, "imagem": 300.0}  # exact, case-sensitive match
EXAM_COST_OTHER = 150.0  # any other type, NULL included
PRESCRIPTION_COST = 50.0
EVENT_CONSULTA = "Consulta"
EVENT_PROCEDIMENTO = "Procedimento"

CURATED_TABLES = ("dim_hospital", "dim_profissional", "fato_consultas_procedimentos", "fato_exames_receitas")

CURATED_DESCRIPTIONS = {
    "dim_hospital": "Hospital dimension; key id_hospital.",
    "dim_profissional": "Professional dimension; key id_profissional.",
    "fato_consultas_procedimentos": (
        "Consultations and procedures, one row each; tipo_evento tells them apart. "
        "id_hospital (string) joins dim_hospital after a cast to int."
    ),
    "fato_exames_receitas": (
        "Exams and prescriptions with cost; id_hospital comes from the patient's admissions, "
        "so a patient with n admissions yields n rows per event."
    ),
}


# ---------------------------------------------------------------------------
# Curated derivations
# ---------------------------------------------------------------------------
def dim_hospital(hospitais: DataFrame) -> DataFrame:
    return hospitais.select("id_hospital", "nome", "cidade", "estado")


def dim_profissional(profissionais: DataFrame) -> DataFrame:
    return profissionais.select("id_profissional", "nome", "especialidade", "crm")


def fato_consultas_procedimentos(consultas: DataFrame, procedimentos: DataFrame) -> DataFrame:
    """Consultations and procedures aligned to nine columns, bag union.

    Both branches are cast explicitly: the professional and hospital ids are
    int on one side and NULL on the other, and the published schema types
    them as string. Implicit union widening would depend on ANSI mode.
    """
    cons = consultas.selectExpr(
        "CAST(id_consulta AS INT) AS id_fato",
        "CAST(id_paciente AS INT) AS id_paciente",
        "CAST(id_profissional AS STRING) AS id_profissional",
        "data_consulta AS data_evento",
        f"'{EVENT_CONSULTA}' AS tipo_evento",
        "CAST(diagnostico AS STRING) AS diagnostico",
        "CAST(NULL AS STRING) AS procedimento",
        "CAST(NULL AS DOUBLE) AS custo_estimado",
        "CAST(NULL AS STRING) AS id_hospital",
    )
    procs = procedimentos.selectExpr(
        "CAST(id_procedimento AS INT) AS id_fato",
        "CAST(id_paciente AS INT) AS id_paciente",
        "CAST(NULL AS STRING) AS id_profissional",
        "data_procedimento AS data_evento",
        f"'{EVENT_PROCEDIMENTO}' AS tipo_evento",
        "CAST(NULL AS STRING) AS diagnostico",
        "CAST(tipo AS STRING) AS procedimento",
        "CAST(NULL AS DOUBLE) AS custo_estimado",
        "CAST(hospital_id AS STRING) AS id_hospital",
    )
    return cons.unionByName(procs)


def exam_cost_sql(tipo: str = "tipo") -> str:
    """Cost of an exam by its type; unknown or NULL types cost the default."""
    branches = " ".join(f"WHEN {tipo} = '{name}' THEN CAST({cost} AS DOUBLE)" for name, cost in EXAM_COSTS.items())
    return f"CASE {branches} ELSE CAST({EXAM_COST_OTHER} AS DOUBLE) END"


def fato_exames_receitas(
    exames: DataFrame,
    receitas: DataFrame,
    consultas: DataFrame,
    internacoes: DataFrame,
    profissionais: DataFrame,
    hospitais: DataFrame,
    assume_unique_dims: bool = False,
    dedupe_admissions: str | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Exams and prescriptions with cost, patient, professional and hospital.

    Exams and prescriptions differ only in their projection, so they are
    aligned first and run through one join chain (half the joins of two
    chains; equal as a bag). The chain is
    event -> consulta (patient, professional) -> admissions (hospital, may
    fan out) -> professional -> hospital. Admissions are joined as counts
    (patient, hospital, n). The last two joins add no column; they only
    multiply rows when a dimension key is duplicated, so the fact is matched
    against the duplicated keys alone (``times_in``), and not at all when
    ``assume_unique_dims`` (keys enforced by the upsert).
    ``dedupe_admissions='latest'`` keeps one admission per patient instead of
    the faithful fan-out.
    """
    events = exames.selectExpr(
        "id_exame AS id_evento",
        "id_consulta",
        "tipo AS tipo_evento",
        "resultado AS descricao",
        "data",
        f"{exam_cost_sql('tipo')} AS custo",
    ).unionByName(
        receitas.selectExpr(
            "id_receita AS id_evento",
            "id_consulta",
            "medicamento AS tipo_evento",
            "dosagem AS descricao",
            "inicio AS data",
            f"CAST({PRESCRIPTION_COST} AS DOUBLE) AS custo",
        )
    )
    cons = consultas.select("id_consulta", "id_paciente", "id_profissional")
    adm = internacoes.select("id_paciente", "id_hospital")
    if dedupe_admissions == "latest":
        latest = F.max_by(F.struct("id_hospital"), F.struct("data_entrada", "id_internacao"))
        adm = (
            internacoes.groupBy("id_paciente")
            .agg(latest.alias("__a"))
            .select("id_paciente", F.col("__a.id_hospital").alias("id_hospital"))
        )
    elif dedupe_admissions is not None:
        raise ValueError("dedupe_admissions must be None or 'latest'")

    chain = events.join(cons, "id_consulta", "left")
    chain = left_join_counted(chain, adm, "id_paciente", "id_hospital")
    if not assume_unique_dims:
        chain = times_in(chain, profissionais, "id_profissional", broadcast_rows)
        chain = times_in(chain, hospitais, "id_hospital", broadcast_rows)
    return chain.selectExpr(
        "CAST(id_evento AS INT) AS id_evento",
        "CAST(id_consulta AS INT) AS id_consulta",
        "CAST(id_paciente AS INT) AS id_paciente",
        "CAST(id_profissional AS INT) AS id_profissional",
        "CAST(id_hospital AS INT) AS id_hospital",
        "CAST(tipo_evento AS STRING) AS tipo_evento",
        "CAST(descricao AS STRING) AS descricao",
        "data",
        "CAST(custo AS DOUBLE) AS custo",
    )


def curate(staged: dict[str, DataFrame], **options) -> dict[str, DataFrame]:
    """All four curated tables from the seven staged ones (lazy)."""
    return {
        "dim_hospital": dim_hospital(staged["hospitais"]),
        "dim_profissional": dim_profissional(staged["profissionais_saude"]),
        "fato_consultas_procedimentos": fato_consultas_procedimentos(
            staged["consultas"], staged["procedimentos"]
        ),
        "fato_exames_receitas": fato_exames_receitas(
            staged["exames"],
            staged["receitas"],
            staged["consultas"],
            staged["internacoes"],
            staged["profissionais_saude"],
            staged["hospitais"],
            **options,
        ),
    }


# ---------------------------------------------------------------------------
# The data-quality rulesets of the curated layer, as written
# for the source system (27 + 28 + 14 + 14 rules).
# ---------------------------------------------------------------------------
RULESET_TEXT = {
    "fato_consultas_procedimentos": """
        Rules = [
            ColumnExists "id_fato",
            ColumnExists "id_paciente",
            ColumnExists "id_profissional",
            ColumnExists "data_evento",
            ColumnExists "tipo_evento",
            ColumnExists "diagnostico",
            ColumnExists "procedimento",
            ColumnExists "custo_estimado",
            ColumnExists "id_hospital",

            IsComplete "id_fato",
            IsComplete "id_paciente",
            IsComplete "id_profissional",
            IsComplete "data_evento",
            IsComplete "procedimento",

            ColumnDataType "id_fato" = "int",
            ColumnDataType "id_paciente" = "int",
            ColumnDataType "id_profissional" = "string",
            ColumnDataType "data_evento" = "date",
            ColumnDataType "tipo_evento" = "string",
            ColumnDataType "diagnostico" = "string",
            ColumnDataType "procedimento" = "string",
            ColumnDataType "custo_estimado" = "double",
            ColumnDataType "id_hospital" = "string",

            RowCount > 0,

            CustomSql "SELECT id_fato FROM primary GROUP BY id_fato HAVING COUNT(*) > 1",
            CustomSql "SELECT custo_estimado FROM primary WHERE custo_estimado < 0",
            CustomSql "SELECT data_evento FROM primary WHERE data_evento > current_date"
        ]
    """,
    "fato_exames_receitas": """
        Rules = [
            ColumnExists "id_evento",
            ColumnExists "id_consulta",
            ColumnExists "id_paciente",
            ColumnExists "id_profissional",
            ColumnExists "id_hospital",
            ColumnExists "tipo_evento",
            ColumnExists "descricao",
            ColumnExists "data",
            ColumnExists "custo",

            IsComplete "id_evento",
            IsComplete "id_consulta",
            IsComplete "id_paciente",
            IsComplete "tipo_evento",
            IsComplete "descricao",
            IsComplete "data",

            ColumnDataType "id_evento" = "int",
            ColumnDataType "id_consulta" = "int",
            ColumnDataType "id_paciente" = "int",
            ColumnDataType "id_profissional" = "int",
            ColumnDataType "id_hospital" = "int",
            ColumnDataType "tipo_evento" = "string",
            ColumnDataType "descricao" = "string",
            ColumnDataType "data" = "date",
            ColumnDataType "custo" = "double",

            RowCount > 0,

            CustomSql "SELECT id_evento FROM primary GROUP BY id_evento HAVING COUNT(*) > 1",
            CustomSql "SELECT custo FROM primary WHERE custo < 0",
            CustomSql "SELECT data FROM primary WHERE data > current_date"
        ]
    """,
    "dim_hospital": """
        Rules = [
            ColumnExists "id_hospital",
            ColumnExists "nome",
            ColumnExists "cidade",
            ColumnExists "estado",

            IsComplete "id_hospital",
            IsComplete "nome",
            IsComplete "cidade",
            IsComplete "estado",

            ColumnDataType "id_hospital" = "int",
            ColumnDataType "nome" = "string",
            ColumnDataType "cidade" = "string",
            ColumnDataType "estado" = "string",

            RowCount > 0,

            CustomSql "SELECT id_hospital FROM primary GROUP BY id_hospital HAVING COUNT(*) > 1"
        ]
    """,
    "dim_profissional": """
        Rules = [
            ColumnExists "id_profissional",
            ColumnExists "nome",
            ColumnExists "especialidade",
            ColumnExists "crm",

            IsComplete "id_profissional",
            IsComplete "nome",
            IsComplete "crm",

            ColumnDataType "id_profissional" = "int",
            ColumnDataType "nome" = "string",
            ColumnDataType "especialidade" = "string",
            ColumnDataType "crm" = "string",

            RowCount > 0,

            CustomSql "SELECT id_profissional FROM primary GROUP BY id_profissional HAVING COUNT(*) > 1",
            CustomSql "SELECT crm FROM primary WHERE LENGTH(crm) < 4"
        ]
    """,
}

# Prefix of the evaluation context name of each table's outcomes; ``evaluate_all`` takes another one.
CONTEXT_PREFIX = "curated_"


def rulesets():
    from strata.operators.quality import load_rules

    return {name: load_rules(text, name) for name, text in RULESET_TEXT.items()}
