"""Table checks, freshness, anomaly monitors and the check report."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Ages in hours, and the anomaly settings (the last runs, how many are needed, z).
WARN_HOURS = 12
ERROR_HOURS = 36
HISTORY_RUNS = 14
MIN_RUNS = 7
MAX_Z = 3.0


@dataclass(frozen=True)
class Check:
    """``rule`` is not_null, unique or accepted_values; ``where`` restricts the rows it looks at."""

    table: str
    column: str
    rule: str
    values: tuple[str, ...] = ()
    where: str | None = None

    @property
    def name(self) -> str:
        return f"{self.table}.{self.column}.{self.rule}"


def _checks(table: str, column: str, *rules: str, values: tuple[str, ...] = (), where: str | None = None):
    return [
        Check(table, column, rule, values if rule == "accepted_values" else (), where)
        for rule in rules
    ]


def _contract() -> list[Check]:
    key = ("not_null", "unique")
    customers, suppliers = "int_clientes_padronizados", "int_fornecedores_padronizados"
    kinds = ("PF", "PJ")
    accepted = "accepted_values"
    return [
        *_checks("empresa_a_clientes", "_source", "not_null"),
        *_checks("empresa_a_clientes", "_batch_id", "not_null"),
        *_checks("stg_empresa_a_clientes", "id_unicad", *key),
        *_checks("stg_empresa_a_clientes", "fonte", "not_null", accepted, values=("empresa_a",)),
        *_checks("stg_empresa_a_clientes", "tipo_cadastro", accepted, values=("cliente",)),
        *_checks("stg_empresa_a_fornecedores", "id_unicad", *key),
        *_checks("stg_empresa_a_fornecedores", "tipo_cadastro", accepted, values=("fornecedor",)),
        *_checks("stg_empresa_b_clientes", "id_unicad", *key),
        *_checks("stg_empresa_b_clientes", "tipo_pessoa", accepted, values=("PF",)),
        *_checks("stg_empresa_c_fornecedores", "id_unicad", *key),
        *_checks("stg_empresa_c_fornecedores", "tipo_pessoa", accepted, values=("PJ",)),
        *_checks("stg_empresa_d_clientes", "id_unicad", "not_null"),
        *_checks("stg_empresa_d_fornecedores", "id_unicad", "not_null"),
        *_checks("stg_empresa_e_clientes", "id_unicad", *key),
        *_checks(customers, "id_unicad", "not_null"),
        *_checks(
            customers,
            "fonte",
            "not_null",
            accepted,
            values=("empresa_a", "empresa_b", "empresa_d", "empresa_e"),
        ),
        *_checks(customers, "tipo_cadastro", accepted, values=("cliente",)),
        *_checks(customers, "tipo_pessoa", accepted, values=kinds),
        *_checks(suppliers, "id_unicad", "not_null"),
        *_checks(
            suppliers, "fonte", "not_null", accepted, values=("empresa_a", "empresa_c", "empresa_d")
        ),
        *_checks(suppliers, "tipo_cadastro", accepted, values=("fornecedor",)),
        *_checks("int_clientes_cluster", "id_unicad", "not_null"),
        *_checks("int_clientes_cluster", "cluster_key", "not_null"),
        *_checks(
            "int_clientes_cluster",
            "match_method",
            "not_null",
            accepted,
            values=("doc_match", "email_to_doc_match", "singleton"),
        ),
        *_checks("int_fornecedores_cluster", "id_unicad", "not_null"),
        *_checks("int_fornecedores_cluster", "cluster_key", "not_null"),
        *_checks("golden_clientes", "id_golden", *key),
        *_checks("golden_clientes", "cluster_key", *key),
        *_checks("golden_clientes", "tipo_pessoa", accepted, values=kinds, where="tipo_pessoa is not null"),
        *_checks("golden_clientes", "score_completude", "not_null"),
        *_checks("golden_fornecedores", "id_golden", *key),
        *_checks("golden_fornecedores", "cluster_key", *key),
    ]


CONTRACT: tuple[Check, ...] = tuple(_contract())


def _failing_rows(check: Check) -> Column:
    column = F.col(check.column)
    failing = column.isNull() if check.rule == "not_null" else ~column.isin(*check.values)
    if check.where:
        failing = F.expr(check.where) & failing
    return F.count_if(failing)


def _duplicate_values(frame: DataFrame, check: Check) -> DataFrame:
    rows = frame.where(F.col(check.column).isNotNull())
    if check.where:
        rows = rows.where(check.where)
    counts = rows.groupBy(check.column).agg(F.count(F.lit(1)).alias("rows"))
    return counts.agg(F.count_if(F.col("rows") > 1).alias("falhas"))


def run_checks(frame: DataFrame, checks: Iterable[Check]) -> DataFrame:
    """``tabela, coluna, regra, falhas, status`` of each check on one table.

    Row checks of the table share one pass; uniqueness needs a count per value, which is combined
    before the shuffle. ``falhas`` counts rows, for ``unique`` the values that appear repeatedly.
    """
    checks = list(checks)
    by_row = [check for check in checks if check.rule != "unique"]
    parts = []
    if by_row:
        counted = frame.agg(
            *[_failing_rows(check).alias(f"f{place}") for place, check in enumerate(by_row)]
        )
        entries = F.array(
            *[
                F.struct(
                    F.lit(check.table).alias("tabela"),
                    F.lit(check.column).alias("coluna"),
                    F.lit(check.rule).alias("regra"),
                    F.col(f"f{place}").alias("falhas"),
                )
                for place, check in enumerate(by_row)
            ]
        )
        parts.append(counted.select(F.inline(entries)))
    for check in checks:
        if check.rule == "unique":
            labels = [F.lit(check.table).alias("tabela"), F.lit(check.column).alias("coluna")]
            parts.append(
                _duplicate_values(frame, check).select(*labels, F.lit("unique").alias("regra"), "falhas")
            )
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union.withColumn("status", F.when(F.col("falhas") == 0, "pass").otherwise("fail"))


def run_contract(tables: dict[str, DataFrame], checks: Iterable[Check] = CONTRACT) -> DataFrame:
    """All checks whose table is given, as one report."""
    grouped: dict[str, list[Check]] = {}
    for check in checks:
        if check.table in tables:
            grouped.setdefault(check.table, []).append(check)
    reports = [run_checks(tables[name], group) for name, group in grouped.items()]
    union = reports[0]
    for report in reports[1:]:
        union = union.unionByName(report)
    return union


def freshness(
    sources: dict[str, DataFrame],
    now: datetime,
    warn_hours: float = WARN_HOURS,
    error_hours: float = ERROR_HOURS,
) -> DataFrame:
    """Age of the newest load per source: ``pass``, ``warn`` or ``error``; no load at all is an error."""
    union = None
    for name, frame in sources.items():
        newest = frame.agg(F.max(F.col("_ingested_at").cast("timestamp")).alias("max_loaded_at"))
        part = newest.select(F.lit(name).alias("unique_id"), "max_loaded_at")
        union = part if union is None else union.unionByName(part)
    at = F.lit(now).cast("timestamp")
    hours = (F.unix_micros(at) - F.unix_micros("max_loaded_at")) / F.lit(3_600_000_000.0)
    status = (
        F.when(F.col("age_hours").isNull() | (F.col("age_hours") > error_hours), "error")
        .when(F.col("age_hours") > warn_hours, "warn")
        .otherwise("pass")
    )
    return (
        union.withColumn("age_hours", hours)
        .withColumn("status", status)
        .withColumn("generated_at", at)
    )


def latest_checks(history: DataFrame) -> DataFrame:
    """Newest entry per source of the freshness history, as a count per status."""
    window = Window.partitionBy("unique_id").orderBy(
        F.col("generated_at").desc_nulls_last(), F.col("status").asc_nulls_last()
    )
    return (
        history.withColumn("_place", F.row_number().over(window))
        .where(F.col("_place") == 1)
        .groupBy("status")
        .agg(F.count(F.lit(1)).alias("fontes"))
    )


def freshness_rollup(history: DataFrame) -> DataFrame:
    """One verdict over the newest check of each source; no history at all is a warning."""
    counts = latest_checks(history)

    def total(*statuses: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("status").isin(*statuses), F.col("fontes"))), F.lit(0))

    rolled = counts.agg(
        total("pass").alias("passou"),
        total("warn").alias("avisos"),
        total("error", "runtime_error").alias("erros"),
        F.count(F.lit(1)).alias("_kinds"),
    )
    status = (
        F.when(F.col("_kinds") == 0, "warn")
        .when(F.col("erros") > 0, "error")
        .when(F.col("avisos") > 0, "warn")
        .otherwise("ok")
    )
    return rolled.withColumn("status", status).drop("_kinds")


def anomalies(
    history: DataFrame,
    dimensions: tuple[str, ...] = ("tabela",),
    *,
    runs: int = HISTORY_RUNS,
    needed: int = MIN_RUNS,
    max_z: float = MAX_Z,
) -> DataFrame:
    """Row count of each run against the runs before it.

    ``history`` has ``run_ts``, ``registros`` and the ``dimensions``; it is one row per run and
    dimension value. A run is anomalous when its z-score over the previous ``runs`` runs is beyond
    ``max_z``; with fewer than ``needed`` earlier runs, or constant ones, it is not judged.
    """
    window = Window.partitionBy(*dimensions).orderBy("run_ts").rowsBetween(-runs, -1)
    value = F.col("registros").cast("double")
    scored = history.withColumns(
        {
            "execucoes_base": F.count("registros").over(window),
            "media": F.avg(value).over(window),
            "desvio": F.stddev_samp(value).over(window),
        }
    )
    judged = (F.col("execucoes_base") >= needed) & (F.col("desvio") > 0)
    z = F.when(judged, (value - F.col("media")) / F.col("desvio"))
    return scored.withColumn("z", z).withColumn(
        "anomalia", F.coalesce(F.abs("z") > max_z, F.lit(False))
    )


def count_run(frame: DataFrame, table: str, run_ts: datetime, dimension: str | None = None) -> DataFrame:
    """History rows of one run: the table's row count, or one count per dimension value."""
    counted = frame.groupBy(*([dimension] if dimension else [])).agg(
        F.count(F.lit(1)).alias("registros")
    )
    return counted.withColumns({"tabela": F.lit(table), "run_ts": F.lit(run_ts).cast("timestamp")})


_CHANGES = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("coluna", "mudanca", "antes", "depois")]
)


def schema_changes(spark: SparkSession, before: T.StructType, after: T.StructType) -> DataFrame:
    """Columns added, removed or changed in type between two versions of a table."""
    old = {field.name: field.dataType.simpleString() for field in before}
    new = {field.name: field.dataType.simpleString() for field in after}
    rows = []
    for name in sorted(old.keys() | new.keys()):
        if name not in old:
            rows.append((name, "added", None, new[name]))
        elif name not in new:
            rows.append((name, "removed", old[name], None))
        elif old[name] != new[name]:
            rows.append((name, "type_changed", old[name], new[name]))
    return spark.createDataFrame(rows, _CHANGES)


def schema_run(frame: DataFrame, table: str, run_ts: datetime) -> DataFrame:
    """History rows of one run: ``tabela, run_ts, coluna, tipo, registros``, one per column of the table."""
    columns = [F.struct(F.lit(f.name).alias("coluna"), F.lit(f.dataType.simpleString()).alias("tipo")) for f in frame.schema]
    counted = frame.agg(F.count(F.lit(1)).alias("registros"))
    return counted.select(
        F.lit(table).alias("tabela"), F.lit(run_ts).cast("timestamp").alias("run_ts"), F.inline(F.array(*columns)), "registros"
    )


def schema_drift(history: DataFrame) -> DataFrame:
    """``tabela, run_ts, coluna, mudanca, antes, depois, registros``: what each run changed against the run before it.

    ``history`` has the rows of ``schema_run``; a run entered twice counts once. The first run of a table changes
    nothing. ``registros`` are the rows of the changed table; a renamed column is removed and added.
    """
    columns = history.select("tabela", "run_ts", "coluna", "tipo", "registros").dropDuplicates(["tabela", "run_ts", "coluna"])
    runs = columns.groupBy("tabela", "run_ts").agg(F.max("registros").alias("registros"))
    # one row per run of a table
    order = Window.partitionBy("tabela").orderBy("run_ts")
    steps = runs.withColumn("anterior", F.lag("run_ts").over(order)).where(F.col("anterior").isNotNull())
    key = ["tabela", "run_ts", "coluna"]
    after = steps.drop("anterior").join(columns.drop("registros"), ["tabela", "run_ts"])
    after = after.select(*key, F.col("tipo").alias("depois"))
    before = steps.join(columns.select("tabela", F.col("run_ts").alias("anterior"), "coluna", F.col("tipo").alias("antes")), ["tabela", "anterior"])
    both = before.select(*key, "antes").join(after, key, "full")
    kind = (
        F.when(F.col("antes").isNull(), "added").when(F.col("depois").isNull(), "removed").otherwise("type_changed")
    )
    changed = both.where(~F.col("antes").eqNullSafe(F.col("depois"))).withColumn("mudanca", kind)
    return changed.join(runs, ["tabela", "run_ts"]).select(*key, "mudanca", "antes", "depois", "registros")


# Operational report

Outcome = tuple[str, str, str]  # status, detail, suggested action
REPORT = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in ("name", "category", "status", "detail", "suggested_action")
    ]
    + [T.StructField("checked_at", T.TimestampType())]
)


def freshness_check(history: DataFrame) -> Outcome:
    row = freshness_rollup(history).first()
    counted = f"{row['passou']} pass, {row['avisos']} warn, {row['erros']} error"
    if row["passou"] + row["avisos"] + row["erros"] == 0:
        return "warn", "no freshness checks recorded", "run the freshness check"
    return row["status"], counted, "" if row["status"] == "ok" else "ingest the late sources"


def quarantine_check(objects: DataFrame) -> Outcome:
    """Batches with objects in the quarantine: a batch is a folder of files, or a file."""
    folder = F.regexp_extract("path", r"^(.*\.parquet)/[^/]*$", 1)
    held = objects.select(F.when(folder != "", folder).otherwise(F.col("path"))).distinct().count()
    if held == 0:
        return "ok", "no batches in quarantine", ""
    return "warn", f"{held} batches in quarantine", "look into them, reprocess, then remove them"


def age_check(objects: DataFrame, now: datetime, max_hours: float = ERROR_HOURS) -> Outcome:
    """Newest file of a report folder; none, or one too old, is a warning."""
    newest = objects.agg(F.unix_micros(F.max("modificationTime").cast("timestamp"))).first()[0]
    if newest is None:
        return "warn", "not written yet", "run the job that writes it"
    hours = now.timestamp() / 3600 - newest / 3_600_000_000
    if hours > max_hours:
        return "warn", f"last written {hours:.1f}h ago", "run the job that writes it"
    return "ok", f"written {hours:.1f}h ago", ""


def check_report(
    spark: SparkSession,
    checks: Iterable[tuple[str, str, Callable[[], Outcome]]],
    now: datetime | None = None,
) -> DataFrame:
    """One row per (name, category, check); a check that raises is ``unknown`` and stops nothing."""
    rows = []
    for name, category, check in checks:
        try:
            status, detail, action = check()
        except Exception as error:  # noqa: BLE001 - any failure must only mark its own check
            status, detail, action = "unknown", f"check failed: {error}", ""
        rows.append((name, category, status, detail, action, now or datetime.now(UTC)))
    return spark.createDataFrame(rows, REPORT)


def report_counts(report: DataFrame) -> DataFrame:
    return report.groupBy("status").agg(F.count(F.lit(1)).alias("verificacoes"))
