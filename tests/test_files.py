"""Files written and read back."""

import gzip

import pandas as pd
import pytest
from conftest import rows

from check import connect, differences
from trackline import plans
from trackline.session import materialized, scratch_dir
from trackline.sources import readers, writers

DATA = [(1, "Düsseldorf", 2.5), (2, "机场", None), (3, 'a "b", c', -1.0)]
SCHEMA = "id INT, name STRING, x DOUBLE"


@pytest.fixture
def df(spark):
    return spark.createDataFrame(DATA, SCHEMA)


def test_csv(spark, df, tmp_path):
    writers.write_csv(df, str(tmp_path / "out"))
    assert rows(readers.read_csv(spark, str(tmp_path / "out"), SCHEMA)) == rows(df)


def test_csv_append_in_another_encoding(spark, tmp_path):
    df = spark.createDataFrame([(2, "机场", 1.0)], SCHEMA)
    path = str(tmp_path / "out")
    for _ in range(2):
        writers.write_csv(df, path, mode="append", encoding="GBK")
    raw = b"".join(p.read_bytes() for p in (tmp_path / "out").glob("*.csv"))
    assert raw.count("机场".encode("GBK")) == 2


@pytest.fixture
def plain_session(spark):
    """A session that was made without the defaults of trackline.session."""
    other = spark.newSession()
    other.conf.set("spark.sql.legacy.javaCharsets", "false")
    return other


def test_csv_append_in_a_session_without_the_defaults(plain_session, sf_dir):
    got = plans.QUERIES["csv_append"](plain_session, sf_dir).toPandas()
    assert differences(got, connect(sf_dir).sql(plans.ORACLE["csv_append"]).df()) is None


def test_csv_append_of_odd_events(plain_session, tmp_path):
    kinds = ["view", "", " ", "tail ", "\ttab\t", 'a"b', "a,b", "back\\", "a\nb", "a\r\nb", "机场", None, "no id"]
    ids = pd.array([*range(-6, len(kinds) - 7), None], "Int64")
    pd.DataFrame({"event_id": ids, "event_type": kinds}).to_parquet(tmp_path / "events.parquet")
    got = plans.QUERIES["csv_append"](plain_session, str(tmp_path)).toPandas()
    assert differences(got, connect(str(tmp_path)).sql(plans.ORACLE["csv_append"]).df()) is None


def test_a_dotted_name_in_another_encoding(plain_session, tmp_path):
    df = plain_session.createDataFrame([(1, " 机场 ")], "id INT, `a.b` STRING")
    writers.write_csv(df, str(tmp_path / "out"), encoding="GBK")
    got = readers.read_csv(plain_session, str(tmp_path / "out"), "id INT, b STRING", encoding="GBK")
    assert rows(got) == [(" 机场 ", 1)]


def test_a_file_in_another_encoding_is_read_without_the_defaults(plain_session, tmp_path):
    (tmp_path / "in.csv").write_text("id,name,x\n1,机场,2.5\n", encoding="GBK")
    got = readers.read_csv(plain_session, str(tmp_path / "in.csv"), SCHEMA, encoding="GBK")
    assert rows(got) == [(1, "机场", 2.5)]


@pytest.mark.parametrize("encoding", ["GBK", "ISO-8859-1"])
def test_what_an_encoding_lacks_is_an_error(plain_session, tmp_path, encoding):
    df = plain_session.createDataFrame([(1, "😀", 1.0)], SCHEMA)
    with pytest.raises(Exception, match="MALFORMED_CHARACTER_CODING"):
        writers.write_csv(df, str(tmp_path / "out"), encoding=encoding)


def test_gzipped_csv_under_a_glob(spark, tmp_path):
    for day in ("a.csv", "b.csv"):
        (tmp_path / day).mkdir()
        with gzip.open(tmp_path / day / "part.gz", "wt") as out:
            out.write("id,name,x\n1,one,1.5\n2,two,\n")
    got = readers.read_csv(spark, f"{tmp_path}/*.csv/*.gz", SCHEMA, spread=4)
    assert got.count() == 4


def test_bad_lines_are_found(spark, tmp_path):
    (tmp_path / "in.csv").write_text("id,name,x\n1,one,1.5\ntwo,two,2\n3,three\n4,four,4\n")
    got = readers.read_dirty_csv(spark, str(tmp_path / "in.csv"), SCHEMA).cache()
    assert got.filter("_bad_line IS NOT NULL").count() == 2
    assert {r.id for r in readers.good_lines(got).collect()} == {1, 4}


def test_json_records(spark, df, tmp_path):
    writers.write_json(df, str(tmp_path / "lines"))
    assert rows(readers.read_json_records(spark, str(tmp_path / "lines"), SCHEMA)) == rows(df)
    (tmp_path / "array.json").write_text('[{"id": 1, "name": "a"}, {"id": 2, "x": 3.5}]')
    got = readers.read_json_records(spark, str(tmp_path / "array.json"), SCHEMA, array=True)
    assert rows(got) == rows(spark.createDataFrame([(1, "a", None), (2, None, 3.5)], SCHEMA))
    assert writers.json_text(df).filter("json LIKE '%\"id\":1%'").count() == 1


def test_states(spark):
    text = (
        '{"states": [["4840d6", "KLM10 ", null, 1, 2, 4.5, 52.1, 100.5, false, 1, 90, 0, null, 3000],'
        ' ["x", "", null, 1, 2, 4.5, 52.1, 0, true, 1, 90, 0, null, 0],'
        ' ["y", "BAW1", null, 1, 2, null, 52.1, 0, true, 1, 90, 0, null, 0]]}'
    )
    df = spark.createDataFrame([(7, text)], "at int, response string")
    (row,) = readers.parse_states(df, "response").collect()
    assert row.asDict() == {
        "at": 7, "id": "4840d6", "callsign": "KLM10 ", "lon": 4.5, "lat": 52.1,
        "baro_altitude": 100.5, "on_ground": False, "bearing": 90.0, "alt": 3000.0,
    }


def test_census(spark, tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    (tmp_path / "a" / "one.txt").write_bytes(b"12345")
    (tmp_path / "a" / "b" / "two.bin").write_bytes(b"1234567")
    row = readers.file_census(spark, str(tmp_path)).first()
    assert (row.files, row.bytes) == (2, 12)


def test_several_parquet_paths(spark, df, tmp_path):
    for day in "ab":
        writers.write_parquet(df, str(tmp_path / day))
    both = readers.read_table(spark, str(tmp_path / "a"), str(tmp_path / "b"))
    assert rows(both) == rows(df.unionByName(df))


def test_scratch_folder_is_the_clusters(spark, df, shared):
    assert scratch_dir(spark).startswith(f"{shared}/")
    kept = materialized(df)
    assert rows(kept) == rows(df)
    folder = shared.removeprefix("file:")
    assert all(folder in path for path in kept.inputFiles())
