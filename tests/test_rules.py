"""Every small case through every form of the pipeline."""

import pytest
from cases import CASES, all_rows
from pyspark.sql import functions as F

from docweave import schemas as S
from docweave.functions.columns import completeness
from docweave.functions.lifecycle import Lifetimes
from docweave.operators.enrich import document_history
from docweave.operators.expiry import lifecycle
from docweave.operators.running import by_history_length
from docweave.operators.stock_map import attach_stock_map
from docweave.streaming.processor import ARRIVAL, enrich

DAY = Lifetimes.hours(24, 24, 24)


def _frame(spark, rows):
    return spark.createDataFrame([tuple(r[f] for f in S.CHANGE.fieldNames()) for r in rows], S.CHANGE)


def _history(changes, layout):
    rows = attach_stock_map(document_history(changes, layout), layout)
    outcome = (
        F.when(F.col("kind") == "D", "deleted")
        .when(~F.col("accepted"), "stale")
        .when(F.col("unchanged"), "suppressed")
        .otherwise("emitted")
    )
    return rows.withColumn("outcome", outcome)


def _windows(spark, tmp, max_rows):
    return by_history_length(_frame(spark, all_rows(idle=False)), _history, max_rows=max_rows)


def _fold(spark, tmp, max_rows):
    return lifecycle(_frame(spark, all_rows(idle=True)), DAY, max_rows=max_rows)


def _stream(spark, tmp, files):
    """The rows in arrival order, cut into files that become micro-batches."""
    rows = sorted(all_rows(idle=True), key=lambda r: r["seq"])
    step = -(-len(rows) // files)
    for i in range(files):
        part = _frame(spark, rows[i * step : (i + 1) * step])
        part.coalesce(1).write.parquet(f"{tmp}/in/{i}")
    source = (
        spark.readStream.schema(S.CHANGE)
        .option("maxFilesPerTrigger", 1)
        .option("recursiveFileLookup", "true")
        .parquet(f"{tmp}/in")
    )
    query = (
        enrich(source, DAY, ARRIVAL)
        .writeStream.outputMode("update")
        .option("checkpointLocation", f"{tmp}/checkpoint")
        .foreachBatch(lambda df, i: df.write.mode("overwrite").parquet(f"{tmp}/out/{i}"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.option("recursiveFileLookup", "true").parquet(f"{tmp}/out")


FORMS = {
    "windows": (_windows, 1000),
    "windows_blocked": (_windows, 2),
    "fold": (_fold, 1000),
    "fold_blocked": (_fold, 2),
    "stream_one_batch": (_stream, 1),
    "stream_batches": (_stream, 3),
}


@pytest.fixture(scope="module")
def results(spark, tmp_path_factory):
    done = {}

    def get(form):
        if form not in done:
            make, size = FORMS[form]
            df = make(spark, tmp_path_factory.mktemp(form), size).withColumn(
                "completeness", completeness(F.col("name"), F.col("price"), F.col("total_stock"))
            )
            done[form] = {(r.product_id, r.seq): r for r in df.collect()}
        return done[form]

    return get


@pytest.mark.parametrize("form", FORMS)
@pytest.mark.parametrize("name", CASES)
def test_case(results, form, name):
    case = CASES[name]
    if case.idles and form.startswith("windows"):
        pytest.skip("no expiry in this form")
    rows = results(form)
    for seq, expected in enumerate(case.expected):
        row = rows[name, seq]
        for column, value in expected.items():
            got = row[column]
            if isinstance(value, float):
                assert got == pytest.approx(value), (seq, column)
            else:
                assert got == value, (seq, column)
