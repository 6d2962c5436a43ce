"""Sources, sinks, views and tables on the small examples of the reference jobs."""

from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tessera.operators import relational as R
from tessera.session import scratch_path
from tessera.sources import catalog as C
from tessera.sources import files as FS
from tests.conftest import rows

PEOPLE_JSON = ['{"name":"Michael"}', '{"name":"Andy", "age":30}', '{"name":"Justin", "age":19}']
PEOPLE_TXT = ["Michael, 29", "Andy, 30", "Justin, 19"]


def text_file(spark, lines, name):
    path = scratch_path(spark, name)
    FS.write_text(spark.createDataFrame([(x,) for x in lines], "value string"), path, single_file=True)
    return path


def test_json_inferred_schema_and_people_queries(spark):
    df = FS.read_json_inferred(spark, text_file(spark, PEOPLE_JSON, "people-json"))
    assert dict((f.name, f.dataType.simpleString()) for f in df.schema.fields) == {"age": "bigint", "name": "string"}
    assert rows(R.filter_gt(df, "age", 21), "age", "name") == [(30, "Andy")]
    got = {r["age"]: r["n"] for r in R.group_count(df, "age").collect()}
    assert got == {None: 1, 19: 1, 30: 1}


def test_delimited_people_view_and_sql(spark):
    lines = FS.read_text(spark, text_file(spark, PEOPLE_TXT, "people-txt"))
    people = FS.parse_delimited(lines, ",", [("name", "string"), ("age", "int")])
    view = C.temp_view(people, "people_t")
    teen = spark.sql(f"SELECT name FROM {view} WHERE age BETWEEN 13 AND 19")
    assert rows(R.format_rows(teen, "Name: %s", "name"), "text") == [("Name: Justin",)]


def test_programmatic_string_schema(spark):
    schema = FS.schema_from_names("name age")
    df = FS.read_csv(spark, text_file(spark, PEOPLE_TXT, "people-csv"), schema, header=False,
                     ignoreLeadingWhiteSpace=True)
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["string", "string"]
    assert sorted(rows(df, "name", "age")) == [("Andy", "30"), ("Justin", "19"), ("Michael", "29")]


def test_table_load_count_and_join_with_view(spark):
    name = C.create_table(spark, "src_kv", "key INT, value STRING", scratch_path(spark, "kv-table"))
    kv = spark.range(0, 500).select((F.col("id") % 250).cast("int").alias("key")) \
        .select("key", F.concat(F.lit("val_"), F.col("key").cast("string")).alias("value"))
    C.load_table(spark, name, kv)
    assert spark.sql(f"SELECT count(*) FROM {name}").first()[0] == 500
    small = spark.sql(f"SELECT key, value FROM {name} WHERE key < 10 ORDER BY key")
    assert [r["key"] for r in small.collect()] == sorted([k for k in range(10)] * 2)
    records = spark.range(1, 101).select(F.col("id").cast("int").alias("key"),
                                         F.format_string("val_%d", "id").alias("value"))
    C.temp_view(records, "records")
    joined = spark.sql(f"SELECT r.key, s.value FROM records r JOIN {name} s ON r.key = s.key")
    assert joined.count() == 200
    C.load_table(spark, name, kv.limit(0))  # overwrite with nothing: reloading replaces, never appends
    assert spark.sql(f"SELECT count(*) FROM {name}").first()[0] == 0


def test_global_view_from_new_session_and_replace(spark):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    name = C.global_view(df, "gv_people")
    C.global_view(df, "gv_people")  # a second registration must not fail
    assert rows(C.query_from_new_session(spark, f"SELECT k, v FROM {name}"), "k", "v") == [(1, "a")]


def test_csv_header_subset_try_cast_then_dropna(spark):
    lines = ["player_name,SHOT_DIST,CLOSE_DEF_DIST,SHOT_CLOCK,GAME_ID",
             "a,7.7,1.3,10.8,1", "b,28.2,6.1,,2", "c,10.1,0.9,n/a,3", "d,3.5,2.0,4.0,4"]
    raw = FS.read_csv(spark, text_file(spark, lines, "shots-csv"))
    cols = ["SHOT_DIST", "CLOSE_DEF_DIST", "SHOT_CLOCK"]
    typed = raw.select("player_name", *[F.col(c).try_cast("double").alias(c) for c in cols]).dropna()
    assert sorted(rows(typed, "player_name", "SHOT_CLOCK")) == [("a", 10.8), ("d", 4.0)]


def test_libsvm_round_trip(spark):
    data = [(float(i), Vectors.dense([v, v, v])) for i, v in enumerate([0.0, 0.1, 0.2, 9.0, 9.1, 9.2])]
    path = FS.write_libsvm(spark.createDataFrame(data, ["label", "features"]), scratch_path(spark, "svm"))
    back = FS.read_libsvm(spark, path, 3)
    assert sorted((r["label"], list(r["features"].toArray())) for r in back.collect()) == \
        sorted((lab, list(v.toArray())) for lab, v in data)


def test_text_sink_round_trip(spark):
    counts = spark.createDataFrame([("a", 2), ("", 1)], "word string, n bigint")
    path = FS.write_text(counts, scratch_path(spark, "sink"), F.format_string("(%s,%d)", "word", "n"))
    assert sorted(rows(FS.read_text(spark, path), "value")) == [("(,1)",), ("(a,2)",)]
