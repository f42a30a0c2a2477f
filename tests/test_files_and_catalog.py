"""Readers, writers, views, tables, Kafka records, session facts, text and incident jobs."""

from pathlib import Path

import pytest
from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T
from table_rows import rows

from tallyhouse.plans import incidents, text
from tallyhouse.plans.ratings import mean_rating, ratings_per_item
from tallyhouse.schemas import DEPARTMENT, MOVIE, PERSON, PERSON_WITH_DEPARTMENT, RATING, USER
from tallyhouse.session import build_session, remove_written, session_info, shared_dir, write_through
from tallyhouse.sinks.catalog import create_table, load_into_table, publish_view
from tallyhouse.sinks.files import write_files, write_pairs, write_text
from tallyhouse.sinks.kafka import encode_rows, kafka_sink_options, topic_records, write_kafka
from tallyhouse.sources.files import (
    as_schema,
    drop_header,
    query_files,
    read_csv_text,
    read_json_once,
    read_delimited,
    read_json,
    read_lines,
    typed_fields,
)
from tallyhouse.sources.streams import kafka_source_options, message_values, random_integers


def put(folder, name, content):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(content)
    return str(folder)


@pytest.fixture
def ratings_folder(tmp_path):
    put(tmp_path / "users", "users.dat", "1::F::20::student::28001\n2::M::31::baker::28002\nx::M\n")
    put(tmp_path / "ratings", "ratings.dat", "1::10::4::978300760\n1::11::5::978300761\n2::10::1::978300762\n9::10::3::1\n")
    put(tmp_path / "movies", "movies.dat", "10::Alien::Horror|Sci-Fi\n11::Big::Comedy\n")
    return tmp_path


def test_delimited_files_and_ratings(spark, ratings_folder):
    users = read_delimited(spark, str(ratings_folder / "users"), USER, "::")
    assert [row[:5] for row in rows(users.where("malformed_line is null"))] == [
        (1, "F", 20, "student", "28001"), (2, "M", 31, "baker", "28002")
    ]
    assert users.where("malformed_line is not null").first().malformed_line == "x::M"
    ratings = read_delimited(spark, str(ratings_folder / "ratings"), RATING, "::")
    movies = read_delimited(spark, str(ratings_folder / "movies"), MOVIE, "::")
    assert {row.genero for row in movies.collect()} == {"Horror|Sci-Fi", "Comedy"}
    assert rows(mean_rating(users, ratings)) == [(1, 4.5), (2, 1.0)]
    assert rows(ratings_per_item(movies, ratings)) == [
        (10, "Alien", 1), (10, "Alien", 3), (10, "Alien", 4), (11, "Big", 5)
    ]
    same = ratings.drop("malformed_line")
    assert same.union(same).count() == 8 and same.union(same).dropDuplicates().count() == 4


def test_csv_without_header_rule(spark, tmp_path):
    path = put(tmp_path / "csv", "a.csv", "a,b\n1,2\na,b\n3,4\n")
    table = read_csv_text(spark, path, ["x", "y"]).drop("malformed_line")
    assert table.count() == 4
    assert rows(drop_header(table, {"x": "a", "y": "b"})) == [("1", "2"), ("3", "4")]
    with_header = read_delimited(spark, path, T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType())]), header=True)
    assert rows(with_header.where("malformed_line is null").drop("malformed_line")) == [(1, 2), (3, 4)]


def test_people(spark, tmp_path):
    path = put(tmp_path / "people", "people.json", '{"name":"Mia"}\n{"name":"Al","age":30,"idDpto":1}\n{"name":"Jo","age":19,"idDpto":2}\n')
    inferred = read_json(spark, path)
    assert dict(inferred.dtypes) == {"age": "bigint", "idDpto": "bigint", "name": "string"}
    people = read_json(spark, path, PERSON_WITH_DEPARTMENT)
    assert rows(as_schema(people, PERSON)) == rows(inferred.select("name", "age"))
    assert query_files(spark, "json", path).count() == 3
    ordered = people.orderBy("age", "name").collect()
    assert [row.name for row in ordered] == ["Mia", "Jo", "Al"], "nulls come first"
    assert people.where("age>21").count() == 1 and people.agg(F.avg("age")).first()[0] == 24.5
    departments = read_json(spark, put(tmp_path / "dep", "d.json", '{"id":1,"name":"Ops"}\n{"id":2,"name":"Lab"}\n'), DEPARTMENT)
    publish_view(people, "people_j")
    publish_view(departments, "departments_j")
    joined = spark.sql("SELECT p.name AS name, d.name AS department FROM people_j p, departments_j d WHERE p.idDpto = d.id")
    assert rows(joined) == [("Al", "Ops"), ("Jo", "Lab")]
    lines = read_lines(spark, put(tmp_path / "txt", "p.txt", "Mia, 29\nAl,30\nJo, x\n"))
    assert rows(typed_fields(lines, "value", PERSON)) == [("Al", 30), ("Jo", None), ("Mia", 29)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        typed_fields(lines, "value", PERSON, strict=True).collect()


@pytest.mark.parametrize("file_format", ["csv", "csv.gzip", "json", "parquet", "orc", "avro"])
def test_round_trips_append_and_overwrite(spark, tmp_path, file_format):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "n int, t string")
    path = str(tmp_path / "out")
    try:
        write_files(df, path, file_format)
    except AnalysisException as error:
        assert file_format == "avro", error
        pytest.skip("no Avro package on the class path")
    write_files(df, path, file_format)
    reader = file_format.removesuffix(".gzip")
    back = spark.read.schema(df.schema).format(reader).load(path)
    assert rows(back) == [(1, "a"), (1, "a"), (2, "b"), (2, "b")]
    write_files(df, path, file_format, mode="overwrite")
    assert rows(spark.read.schema(df.schema).format(reader).load(path)) == [(1, "a"), (2, "b")]


def test_text_and_pairs(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "n int, t string")
    write_files(df, str(tmp_path / "rows"), "text")
    assert rows(spark.read.text(str(tmp_path / "rows"))) == [("[1,a]",), ("[2,null]",)]
    write_text(df.select("n"), str(tmp_path / "one"))
    assert rows(spark.read.text(str(tmp_path / "one"))) == [("1",), ("2",)]
    write_pairs(df.dropna(), str(tmp_path / "pairs"), "n", "t")
    assert spark.sparkContext.sequenceFile(str(tmp_path / "pairs")).collect() == [(1, "a")]
    with pytest.raises(ValueError):
        write_files(df, str(tmp_path / "x"), "xml")


def test_kafka_records(spark):
    df = spark.createDataFrame([("a", "b", None)], "x string, y string, z string")
    assert rows(encode_rows(df)) == [("salida", "[a,b,null]")]
    assert rows(encode_rows(df, "t", as_json=True)) == [("t", '{"x":"a","y":"b"}')]
    records = topic_records({"m": df, "n": df}, {"n": "other"})
    assert [row.topic for part in records for row in part.collect()] == ["salida", "other"]
    assert kafka_sink_options("h:1") == {"kafka.bootstrap.servers": "h:1"}
    assert kafka_source_options("transacciones") == {
        "kafka.bootstrap.servers": "localhost:9092", "subscribe": "transacciones", "startingOffsets": "latest"
    }
    read = spark.sql("SELECT CAST('v' AS BINARY) AS value, TIMESTAMP'2024-01-01 00:00:00' AS timestamp")
    assert message_values(read, "arrival").columns == ["value", "arrival"]
    assert message_values(read).first().value == "v"
    try:
        spark.read.format("kafka").options(**kafka_source_options("t")).load()
    except AnalysisException:
        with pytest.raises(AnalysisException):
            write_kafka(encode_rows(df))


def test_views_and_sessions(spark):
    df = spark.range(3)
    assert publish_view(df, "local_v") == "local_v"
    shared = publish_view(df, "global_v", all_sessions=True)
    assert shared == "global_temp.global_v"
    other = spark.newSession()
    assert other.sql(f"SELECT * FROM {shared}").count() == 3
    with pytest.raises(AnalysisException):
        other.sql("SELECT * FROM local_v").count()


def test_tables(spark, tmp_path):
    schema = T.StructType([T.StructField("age", T.IntegerType()), T.StructField("name", T.StringType())])
    create_table(spark, "people_t", schema)
    create_table(spark, "people_t", schema)
    path = put(tmp_path / "in", "p.csv", "30,Al\n19,Jo\n")
    load_into_table(spark, "people_t", path)
    load_into_table(spark, "people_t", path)
    assert rows(spark.table("people_t")) == [(19, "Jo"), (19, "Jo"), (30, "Al"), (30, "Al")]
    spark.sql("DROP TABLE people_t")


def test_session(spark, tmp_path):
    facts = {row.name: row.value for row in session_info(spark).collect()}
    assert facts["appName"] == "tests" and facts["version"].startswith("4.")
    assert {"defaultParallelism", "sparkUser", "spark.sql.session.timeZone"} <= set(facts)
    assert build_session().conf.get("spark.sql.adaptive.enabled") == "true"
    assert shared_dir(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")
    written = write_through(spark.range(5), "five")
    assert written.count() == 5 and shared_dir(spark) in written.inputFiles()[0]
    assert write_through(spark.range(2), "five").count() == 2


def test_persistence_and_plans(spark, capsys):
    df = spark.range(10).cache()
    assert df.count() == 10 and df.is_cached
    assert df.unpersist().persist(StorageLevel.MEMORY_AND_DISK).storageLevel.useDisk
    df.unpersist()
    assert spark.range(0, 10, 1, 4).repartition(2).rdd.getNumPartitions() == 2
    df.explain("formatted")
    df.printSchema()
    df.show(3)
    shown = capsys.readouterr().out
    assert "Physical Plan" in shown and "id: long" in shown and "only showing top 3 rows" in shown
    seen = []
    df.limit(1).foreachPartition(lambda part: seen.extend(part))
    assert df.columns == ["id"] and df.take(2)[1].id == 1 and df.first().id == 0
    assert df.rdd.map(lambda row: row.id).reduce(lambda a, b: a + b) == 45
    assert spark.sparkContext.parallelize([(1, "a")]).toDF("n int, t string").count() == 1


def test_random_integers(spark):
    values = [row.value for row in random_integers(spark, 500, below=20).collect()]
    assert len(values) == 500 and set(values) <= set(range(20)) and len(set(values)) > 5
    assert values == [row.value for row in random_integers(spark, 500, below=20).collect()]


BOOK = "en un lugar  \nde la mancha\n\n   \n de cuyo nombre\nSancho Quijote lugar lugar\n"


def test_word_jobs(spark, tmp_path):
    lines = read_lines(spark, put(tmp_path / "book", "book.txt", BOOK))
    counts = {row.word: row.n for row in text.word_count(lines).collect()}
    assert counts == {"en": 1, "un": 1, "lugar": 3, "de": 2, "la": 1, "mancha": 1, "": 2, "cuyo": 1, "nombre": 1, "Sancho": 1, "Quijote": 1}
    assert [tuple(row) for row in text.top_words(lines, 3).collect()] == [("lugar", 3), ("cuyo", 1), ("mancha", 1)]
    assert text.mean_word_length(lines).first()[0] == pytest.approx((3 * 5 + 6 + 4 + 6 + 7) / 7)
    write_text(text.word_lengths(lines), str(tmp_path / "lengths"))
    lengths = [int(row.value) for row in spark.read.text(str(tmp_path / "lengths")).collect()]
    assert sorted(lengths) == [4, 5, 5, 5, 6, 6, 7]
    whole = spark.createDataFrame([(1, BOOK), (2, "")], "id int, text string")
    assert rows(text.word_count(text.text_lines(whole))) == rows(text.word_count(lines))


CRIMES = "h0,h1,h2,h3,h4,h5,h6,h7,OFFENCE,h9,h10,AGE\n" + "".join(
    f"a,b,c,d,e,f,g,h,{offence},j,k,{age}\n" for offence, age in [("ROBBERY", "30"), ("ROBBERY", ""), ("ARSON", " 30"), ("ARSON", "x"), ("THEFT", "40")]
)


def test_incident_jobs(spark, tmp_path):
    lines = incidents.without_header_line(read_lines(spark, put(tmp_path / "c", "c.csv", CRIMES)))
    found = incidents.incident_fields(lines)
    assert incidents.incident_total(found).first().n == 5
    assert [tuple(row) for row in incidents.most_frequent(found).collect()] == [("ARSON", 2), ("ROBBERY", 2), ("THEFT", 1)]
    assert incidents.most_frequent(found, n=1).count() == 1
    assert incidents.mean_with_default(found).first().mean_age == (30 + 25 + 25 + 25 + 40) / 5
    short = spark.createDataFrame([("a,b",)], "value string")
    assert rows(incidents.incident_fields(short)) == [(None, None)]
    assert incidents.mean_with_default(incidents.incident_fields(short)).first().mean_age == 25


JSON_LINES = """{"name":"ana","age":30,"home":{"city":"Rome","zip":null},"tags":["a","b"],"mixed":1}
{"name":"ben","age":null,"home":{"city":"Oslo","since":2.5},"mixed":"x","none":null}
not json
[1]

{"age":31,"a b":true,"it's":5,"home":{},"tags":[]}
"""


def test_json_schema_from_one_read(spark, tmp_path):
    source = put(tmp_path / "j", "a.json", JSON_LINES)
    found = read_json_once(spark, source)
    kinds = dict(found.dtypes)
    assert kinds["age"] == "bigint" and kinds["tags"] == "array<string>" and kinds["mixed"] == kinds["none"] == "string"
    assert kinds["home"] == "struct<city:string,since:decimal(2,1),zip:string>" and kinds["a b"] == "boolean"
    people = {row["name"]: row for row in found.where("malformed_line IS NULL").collect()}
    assert people["ana"]["home"]["city"] == "Rome" and people["ana"]["tags"] == ["a", "b"] and people["ana"]["mixed"] == "1"
    assert people["ben"]["age"] is None and people["ben"]["mixed"] == "x" and float(people["ben"]["home"]["since"]) == 2.5
    assert people[None]["a b"] is True and people[None]["it's"] == 5 and people[None]["tags"] == []
    assert sorted(row[0] for row in found.select("malformed_line").dropna().collect()) == ["[1]", "not json"]
    assert not [file for file in found.inputFiles() if source in file], "the source is not read again"


def test_json_once_with_a_schema_and_without_rows(spark, tmp_path):
    source = put(tmp_path / "j", "a.json", '{"name":"ana","age":"old"}\n{"name":"ben","age":"7","x":1}\n')
    assert rows(read_json_once(spark, source, PERSON)) == [("ana", None, None), ("ben", 7, None)]
    assert read_json_once(spark, put(tmp_path / "e", "a.json", "\n")).collect() == []
    assert rows(read_json_once(spark, put(tmp_path / "b", "a.json", "bad\n"))) == [("bad",)]


def test_written_tables_are_removed(spark):
    path = f"{shared_dir(spark)}/tallyhouse/{spark.sparkContext.applicationId}"
    kept = write_through(spark.range(3), "kept-table")
    gone = write_through(spark.range(4), "gone-table")
    assert remove_written(spark, "gone-table") and not remove_written(spark, "gone-table")
    assert kept.count() == 3 and not Path(path, "gone-table").exists() and Path(path, "kept-table").exists()
    assert gone.columns == ["id"]
