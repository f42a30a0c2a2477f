"""Ingest and metrics on the hand-made transactions, batch pipeline included."""

import datetime

import pytest
from table_rows import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyhouse.operators.numbering import with_surrogate_id
from tallyhouse.plans.batch import BATCH_OUTPUTS, load_transactions, run_batch
from tallyhouse.plans.transactions import MetricOptions, speed_metrics, wide_from_rows, wide_from_tables
from tallyhouse.schemas import CUSTOMER, TRANSACTION
from tallyhouse.sources.files import as_schema
from tallyhouse.sources.transactions import accepted, check_transactions, header_of, raw_transactions_of, rejected

HEADER = "when,product,amount,card,name,city,account,open,lat,lon,what"
LINES = [
    HEADER,
    "01/02/09 6:17,P,1200,Visa,ana,London ,C001,u,51.5,-1.1,Cinema",
    "2/1/09 4:53,P,300,Mastercard,ben,London,C002,u,51.5,-0.1,rent",
    "13/01/09 1:00,P,600,Visa,cho,Madrid,C003,u,40.4,-3.7,life insurance",
    "1/13/09 1:00,P,500,Amex,dee,Paris,C004,u,48.8,2.3, Groceries",
    "bad line",
]
OPTIONS = MetricOptions(as_of=datetime.date(2009, 2, 10))
DATES = {"ana": (2009, 2, 1), "ben": (2009, 1, 2), "cho": (2009, 1, 13), "dee": (2010, 1, 1)}


def messages(spark, lines=LINES):
    return spark.createDataFrame([(line,) for line in lines], "value string")


def checked(spark, lines=LINES, **options):
    return check_transactions(raw_transactions_of(messages(spark, lines)), header_of(HEADER), 46, **options)


def check_wide(wide):
    assert wide.count() == 4
    assert sorted(row.DNI for row in wide.collect()) == sorted({row.DNI for row in wide.collect()})
    dates = {row.nombre: row.fecha for row in wide.collect()}
    assert dates == {name: datetime.date(*day) for name, day in DATES.items()}
    categories = {row.nombre: row.categoria for row in wide.collect()}
    assert categories == {"ana": "ocio", "ben": "alquiler", "cho": "seguros", "dee": "otro"}
    found = speed_metrics(wide, OPTIONS)
    assert [tuple(row) for row in found["city_counts"].collect()] == [("London", 2), ("Madrid", 1), ("Paris", 1)]
    assert sorted(row.nombre for row in found["high_payments"].collect()) == ["ana", "cho"]
    london = found["city_rows"].collect()
    assert {row.nombre for row in london} == {"ana", "ben"}
    assert [row.DNI for row in london] == sorted(row.DNI for row in london)
    assert [row.nombre for row in found["category_rows"].collect()] == ["ana"]
    assert sorted(row.nombre for row in found["recent_rows"].collect()) == ["ana", "cho", "dee"]
    assert [tuple(row) for row in found["card_means"].collect()] == [("Visa", 900.0), ("Amex", 500.0), ("Mastercard", 300.0)]


@pytest.mark.parametrize("partitions", [1, 2, 8])
def test_messages(spark, partitions):
    raw = raw_transactions_of(messages(spark).repartition(partitions))
    numbered = with_surrogate_id(check_transactions(raw, header_of(HEADER), 46), name="DNI")
    check_wide(wide_from_rows(accepted(numbered)))
    assert rows(rejected(numbered)) == [("bad line", "field count")]


def test_wide_table_from_two_sources(spark):
    good = accepted(with_surrogate_id(checked(spark), name="DNI"))
    wide = wide_from_tables(as_schema(good, TRANSACTION), as_schema(good, CUSTOMER))
    check_wide(wide)


def test_nested_location_and_moment(spark):
    row = accepted(checked(spark)).where("nombre = 'ana'").first()
    assert row.geolocalizacion.asDict() == {"latitud": 51.5, "longitud": -1.1, "ciudad": "London", "pais": "N/A"}
    assert row.momento == datetime.datetime(2009, 2, 1, 6, 17)


def test_reasons(spark):
    good = LINES[1].split(",")

    def changed(position, value):
        return ",".join([*good[:position], value, *good[position + 1:]])

    lines = [changed(2, "x"), changed(8, ""), changed(9, "east"), changed(0, "soon"), LINES[1] + ",more", "", None]
    found = sorted((row.line, row.reason) for row in rejected(checked(spark, lines)).collect())
    assert sorted(reason for _, reason in found) == [
        "amount", "date", "field count", "field count", "field count", "latitude", "longitude"
    ]
    assert (changed(2, "x"), "amount") in found and (LINES[1] + ",more", "field count") in found
    quoted = changed(10, '"Cinema"')
    assert accepted(checked(spark, [quoted])).first().categoria == "ocio"
    with pytest.raises(PySparkException):
        accepted(checked(spark, lines[:1], strict=True)).collect()


def test_header_is_dropped_wherever_it_occurs(spark):
    twice = checked(spark, [HEADER, *LINES[1:3], HEADER])
    assert accepted(twice).count() == 2 and rejected(twice).count() == 0


def write_input(folder):
    folder.mkdir()
    (folder / "transactions.csv").write_text("\n".join(LINES) + "\n")
    return str(folder)


def test_file_ingest(spark, tmp_path):
    wide, bad = load_transactions(spark, write_input(tmp_path / "in"), pivot_year=46)
    check_wide(wide)
    assert [row.DNI for row in wide.orderBy("DNI").collect()] == [1, 2, 3, 4]
    assert rows(bad) == [("bad line", "field count")]


def test_batch_pipeline(spark, tmp_path):
    source, out = write_input(tmp_path / "in"), str(tmp_path / "out")
    formats = {"recent_rows": "parquet"}

    def counts():
        folder = {name: f"{out}/{path}" for name, (path, _) in BATCH_OUTPUTS.items()}
        return [
            spark.read.csv(folder["city_counts"]).count(),
            spark.read.json(folder["high_payments"]).count(),
            spark.read.parquet(folder["city_rows"]).count(),
            spark.read.csv(folder["category_rows"]).count(),
            spark.read.parquet(folder["recent_rows"]).count(),
            spark.read.json(f"{out}/rejects.json").count(),
        ]

    run_batch(spark, source, out, OPTIONS, formats=formats, pivot_year=46)
    assert counts() == [3, 2, 2, 1, 3, 1]
    run_batch(spark, source, out, OPTIONS, formats=formats, pivot_year=46)
    assert counts() == [6, 4, 4, 2, 6, 2]
    run_batch(spark, source, out, OPTIONS, mode="overwrite", formats=formats, pivot_year=46)
    assert counts() == [3, 2, 2, 1, 3, 1]
    assert list((tmp_path / "out" / "categoriaOcio.csv.gzip").glob("*.csv.gz"))
    cities = spark.read.csv(f"{out}/clientesCiudad.csv").collect()
    assert sorted(tuple(row) for row in cities) == [("London", "2"), ("Madrid", "1"), ("Paris", "1")]


def test_null_dates_are_not_recent(spark):
    df = spark.createDataFrame([(1, None)], "DNI long, fecha date")
    from tallyhouse.plans.transactions import recent_rows
    assert recent_rows(df, OPTIONS.as_of).count() == 0
    assert df.where(F.col("fecha").isNull()).count() == 1
