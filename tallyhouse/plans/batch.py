"""Batch pipeline: transaction files to five metrics in five formats."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.operators.numbering import with_surrogate_id
from tallyhouse.plans.transactions import MetricOptions, batch_metrics, wide_from_rows
from tallyhouse.schemas import RAW_TRANSACTION_FIELDS
from tallyhouse.sinks.files import write_files
from tallyhouse.sinks.publish import check_formats, publish_run
from tallyhouse.sources.transactions import accepted, check_transactions, read_raw_transactions, rejected

# Folder and format of each result.
BATCH_OUTPUTS = {
    "city_counts": ("clientesCiudad.csv", "csv"),
    "high_payments": ("clientesPagosAltos.json", "json"),
    "city_rows": ("clientesLondres.parquet", "parquet"),
    "category_rows": ("categoriaOcio.csv.gzip", "csv.gzip"),
    "recent_rows": ("transaccionesUltimosDias.avro", "avro"),
}
REJECTS_FOLDER = "rejects.json"


def load_transactions(
    spark: SparkSession, path: str, first_line_is_header: bool = True, pivot_year: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """(wide table, rejected lines) of transaction files.

    The input is read and parsed once: checked rows get their id and are written
    to the shared folder, and everything later reads that table.
    """
    raw = read_raw_transactions(spark, path)
    header = None
    if first_line_is_header:
        first = raw.first()
        header = {field: first[field] for field in RAW_TRANSACTION_FIELDS} if first else None
    numbered = with_surrogate_id(check_transactions(raw, header, pivot_year), name="DNI")
    return wide_from_rows(accepted(numbered)), rejected(numbered)


def run_batch(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    options: MetricOptions = MetricOptions(),
    mode: str = "append",
    formats: Mapping[str, str] | None = None,
    first_line_is_header: bool = True,
    pivot_year: int | None = None,
    run_id: str | None = None,
) -> bool:
    """Write the five batch metrics and the rejected lines under ``output_path``.

    ``mode="append"`` adds to earlier runs, ``"overwrite"`` replaces them.
    ``formats`` replaces the format of a metric, for instance where the Avro
    package is not installed: ``{"recent_rows": "parquet"}``. All formats are checked
    before anything is read or written.

    With a ``run_id`` an append is repeatable: a run that was stopped at any point and is
    started again under its id gives each row once, see :mod:`tallyhouse.sinks.publish`.
    Returns False if that run was published before, True otherwise.
    """
    chosen = {name: (formats or {}).get(name, kind) for name, (_, kind) in BATCH_OUTPUTS.items()}
    check_formats(spark, chosen)
    if run_id is not None and mode != "append":
        raise ValueError("a run id is for appending")

    def outputs() -> dict[str, tuple[DataFrame, str]]:
        wide, bad_lines = load_transactions(spark, input_path, first_line_is_header, pivot_year)
        made = {BATCH_OUTPUTS[name][0]: (result, chosen[name]) for name, result in batch_metrics(wide, options).items()}
        return {**made, REJECTS_FOLDER: (bad_lines, "json")}

    if run_id is not None:
        return publish_run(spark, output_path, run_id, outputs)
    for folder, (result, file_format) in outputs().items():
        write_files(result, f"{output_path}/{folder}", file_format, mode)
    return True
