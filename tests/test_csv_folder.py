import csv
import io
import os
import re

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from almenara.fixed_values import EXPECTED_COLUMNS
from almenara.functions.dates import parse_ordered_timestamp
from almenara.sources import csv_folder as C


def put(folder, name, data):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data if isinstance(data, bytes) else data.encode())


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_encodings_and_names(spark, tmp_path):
    folder = str(tmp_path / "in dir [1]")
    put(folder, "a.csv", "LOCALIDAD;EDAD\nUSAQUÉN;1\n")
    put(folder, "b.CSV", "EDAD;LOCALIDAD\n2;USAQUÉN\n".encode("latin-1"))
    put(folder, "c%20{d}.csv", "LOCALIDAD\nSUBA\n")
    put(folder, "c.txt", "LOCALIDAD\nUSME\n")
    put(folder, "below/d.csv", "LOCALIDAD\nBOSA\n")
    got = C.read_csv_folder(spark, folder).records
    assert got.columns == ["LOCALIDAD", "EDAD"]
    assert rows(got) == [("SUBA", None), ("USAQUÉN", "1"), ("USAQUÉN", "2")]


def test_one_bad_byte_makes_the_whole_file_latin(spark, tmp_path):
    put(str(tmp_path), "a.csv", "LOCALIDAD;EDAD\nSUBÉ;1\n".encode() + b"X\xf1;2\n")
    got = C.read_csv_folder(spark, str(tmp_path)).records
    # two bytes of the UTF-8 letter are read as two letters, then repaired as a pair if listed
    assert rows(got) == [("SUBÃ\u0089", "1"), ("Xñ", "2")]


def test_synonyms_repeats_and_drift(spark, tmp_path):
    folder = str(tmp_path)
    put(folder, "1.csv", "PRIORIDAD;;PRIORIDAD FINAL;FECHA_INICIO_DESPLAZAMIENTO_MOVIL;FECHA_INICIO_DESPLAZAMIENTO_MOVIL;OTRA\n"
        "a;x;b;;t1;z\nc; ;  ;t2;t3;z\n")
    put(folder, "2.csv", "FECHA_INICIO_DESPLAZAMIENTO_MOVIl;FECHA_INICIO_DESPLAZAMIENTO_MOVIL;COD_LOCALIDAD\nl;NULL;7\nl;u;NA\n")
    got = C.read_csv_folder(spark, folder).records
    assert got.columns == ["FECHA_INICIO_DESPLAZAMIENTO_MOVIL", "CODIGO_LOCALIDAD", "PRIORIDAD_FINAL"]
    assert rows(got) == sorted([("t1", None, "b"), ("t2", None, "c"), ("l", "7", None), ("u", None, None)], key=str)


def test_quotes_newlines_blank_lines_bom(spark, tmp_path):
    folder = str(tmp_path)
    put(folder, "q.csv", b'\xef\xbb\xbf"LOCALIDAD";EDAD\n"a;""b""\nc";1\n\n;\n"d";"2"\n')
    put(folder, "plain.csv", "\n\nLOCALIDAD;EDAD\r\n5\" x;3\r\n\r\n;\r\n")
    got = C.read_csv_folder(spark, folder).records
    assert rows(got) == sorted([('a;"b"\nc', "1"), (None, None), ("d", "2"), ('5" x', "3"), (None, None)], key=str)


def test_short_and_long_records(spark, tmp_path):
    put(str(tmp_path), "a.csv", 'LOCALIDAD;EDAD\nSUBA\nUSME;1;extra\n"x;y";2\n"x;y";2;3\n')
    result = C.read_csv_folder(spark, str(tmp_path))
    assert rows(result.records) == sorted([("SUBA", None), ("USME", "1"), ("x;y", "2"), ("x;y", "2")], key=str)
    assert sorted(r.REGISTRO for r in result.malformed.collect()) == ['"x;y";2;3', "USME;1;extra"]


def test_no_known_column_keeps_rows(spark, tmp_path):
    put(str(tmp_path), "a.csv", "FOO;BAR\n1;2\n3;4\n")
    put(str(tmp_path), "b.csv", "EDAD\n5\n")
    assert rows(C.read_csv_folder(spark, str(tmp_path)).records) == sorted([(None,), (None,), ("5",)], key=str)


def test_empty_folder_files_and_missing_folder(spark, tmp_path):
    result = C.read_csv_folder(spark, str(tmp_path))
    assert result.records.columns == EXPECTED_COLUMNS and result.records.isEmpty() and result.malformed.isEmpty()
    put(str(tmp_path), "a.csv", "")
    assert C.read_csv_folder(spark, str(tmp_path)).records.isEmpty()
    put(str(tmp_path), "b.csv", "EDAD;GENERO\n")
    got = C.read_csv_folder(spark, str(tmp_path)).records
    assert got.columns == ["EDAD", "GENERO"] and got.isEmpty()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        C.read_csv_folder(spark, str(tmp_path / "nowhere"))


def test_header_words_in_data_do_not_confuse(spark, tmp_path):
    put(str(tmp_path), "a.csv", "GENERO;EDAD\nEDAD;GENERO\nLOCALIDAD;UNIDAD\n")
    got = C.read_csv_folder(spark, str(tmp_path)).records
    assert got.columns == ["EDAD", "GENERO"]
    assert rows(got) == [("GENERO", "EDAD"), ("UNIDAD", "LOCALIDAD")]


@pytest.mark.parametrize(
    "line", ["a;b;a;a", "a;a.1;a", "a.1;a;a", ";;x", '"a;b";c', "PRIORIDAD FINAL;PRIORIDAD;prioridad", "a;a;a.1;a.1"]
)
def test_header_names_match_pandas(line):
    assert list(C.header_names(line)) == list(pd.read_csv(io.StringIO(line + "\n"), sep=";").columns)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet='";a', max_size=14))
def test_open_quote(line):
    """A line is open exactly when a quoted field swallows what follows it."""
    pattern = re.compile(C.OPEN_QUOTE)
    parsed = list(csv.reader([line + "\n", "zz\n"], delimiter=";"))
    assert bool(pattern.search(line)) == (len(parsed) == 1)


def test_many_random_files_match_pandas(spark, tmp_path):
    """Mixed files against a plain pandas reading of the same bytes."""
    import random

    rng = random.Random(7)
    want = []
    cells = ["SUBA", "ñandú", "a;b", 'q"q', "l1\nl2", "", "NULL", " x ", "Ã¡"]
    for i in range(12):
        names = rng.sample(["LOCALIDAD", "EDAD", "GENERO", "UNIDAD", "OTRA"], 3)
        encoding = rng.choice(["utf-8", "latin-1"])
        out = io.StringIO()
        writer = csv.writer(out, delimiter=";", lineterminator="\n")
        writer.writerow(names)
        for _ in range(rng.randint(0, 9)):
            writer.writerow([rng.choice(cells) for _ in names])
        put(str(tmp_path), f"f{i}.csv", out.getvalue().encode(encoding))
        try:
            pdf = pd.read_csv(tmp_path / f"f{i}.csv", sep=";", dtype=str, encoding="utf-8")
        except UnicodeDecodeError:
            pdf = pd.read_csv(tmp_path / f"f{i}.csv", sep=";", dtype=str, encoding="latin-1")
        want.append(pdf)
    keep = ["LOCALIDAD", "EDAD", "UNIDAD", "GENERO"]
    whole = pd.concat(want, ignore_index=True)[keep]
    whole = whole.map(lambda v: None if pd.isna(v) else v.replace("Ã¡", "á"))
    expected = sorted((tuple(None if pd.isna(v) else v for v in r) for r in whole.values), key=str)
    assert rows(C.read_csv_folder(spark, str(tmp_path)).records) == expected


def test_plan_reads_only_known_columns(spark, tmp_path):
    put(str(tmp_path), "a.csv", "OTRA;EDAD;X\n1;2;3\n")
    records = C.read_csv_folder(spark, str(tmp_path)).records
    plan = records._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<c1:string>" in plan
    assert "Exchange" not in plan and "Python" not in plan


@pytest.fixture
def tiny_splits(spark):
    """Splits of a few bytes, so that small files have many blocks."""
    settings_ = {"spark.sql.files.maxPartitionBytes": "300b", "spark.sql.files.openCostInBytes": "1b"}
    old = {k: spark.conf.get(k) for k in settings_}
    for k, v in settings_.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def random_csv(rng, encoding, n):
    out = io.StringIO()
    writer = csv.writer(out, delimiter=";", lineterminator="\n")
    writer.writerow(["OTRA", "LOCALIDAD", "EDAD"])
    cells = ["x", "ñ", 'a "b"', "l1\nl2", '"', "\n\n", ';";\n";', "", "largo " * 30, '"\n"\n"']
    for _ in range(n):
        if rng.random() < 0.1:
            out.write("\n")
        if rng.random() < 0.1:
            out.write('5" x;sin comillas;"7" y\n')
        writer.writerow([rng.choice(cells) for _ in range(3)])
    return out.getvalue().encode(encoding)


def test_split_files_equal_pandas(spark, tmp_path, tiny_splits):
    import random

    rng = random.Random(11)
    want = []
    for i in range(2):
        data = random_csv(rng, ["utf-8", "latin-1"][i], 60)
        put(str(tmp_path), f"f{i}.csv", data)
        want.append(pd.read_csv(io.BytesIO(data), sep=";", dtype=str, encoding=["utf-8", "latin-1"][i])[["LOCALIDAD", "EDAD"]])
    split = C.read_csv_folder(spark, str(tmp_path)).records
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128m")
    assert rows(split) == rows(C.read_csv_folder(spark, str(tmp_path)).records)
    assert split.count() == sum(map(len, want)) > 100


@pytest.mark.parametrize("split", ["16b", "128m"])
def test_blank_lines_and_late_headers(spark, tmp_path, tiny_splits, split):
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    put(str(tmp_path), "blank.csv", "\n" * 40 + "LOCALIDAD;EDAD\nx;1\ny;2\n")
    put(str(tmp_path), "spaces.csv", '   \nLOCALIDAD;EDAD\n"l1\nl2";3\n   \nz;4\n')
    put(str(tmp_path), "empty.csv", "\n" * 40)
    got = C.read_csv_folder(spark, str(tmp_path)).records
    assert rows(got) == sorted([("x", "1"), ("y", "2"), ("l1\nl2", "3"), ("z", "4")])


def test_long_file_malformed_and_unclosed(spark, tmp_path, tiny_splits):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8b")
    put(str(tmp_path), "a.csv", 'LOCALIDAD;EDAD\n"a\nb";1\nc;2;3\n"d\n;";4;"5\n6"\n')
    result = C.read_csv_folder(spark, str(tmp_path))
    assert rows(result.records) == sorted([("a\nb", "1"), ("c", "2"), ("d\n;", "4")])
    assert sorted(r.REGISTRO for r in result.malformed.collect()) == ['"d\n;";4;"5\n6"', "c;2;3"]
    put(str(tmp_path), "a.csv", 'LOCALIDAD;EDAD\nx;1\n"a;2\nb;3\n')
    with pytest.raises(ValueError, match="not closed"):
        C.read_csv_folder(spark, str(tmp_path))


def test_date_order_is_settled_per_file(spark, tmp_path):
    """``05/02`` is read as the other dates of its file; a file that tells nothing is month first."""
    files = {
        "day.csv": ["25/02/2024 10:00", "05/02/2024 11:00", "13/14/2024"],
        "month.csv": ["02/25/2024 10:00", "05/02/2024 11:00", "31-12-2024"],
        "silent.csv": ["05/02/2024", "2024-02-05"],
    }
    for name, dates_ in files.items():
        lines = "\n".join(f'{name};"{d}"' if i % 2 else f"{name};{d}" for i, d in enumerate(dates_))
        (tmp_path / name).write_text(f"NUMERO_INCIDENTE;FECHA_DESPACHO_518\n{lines}\n", encoding="utf-8")
    # two more dates of the month's order outweigh the one of the day's
    with open(tmp_path / "month.csv", "a", encoding="utf-8") as f:
        f.write("month.csv;03/30/2024\n")
    records = C.read_csv_folder(spark, str(tmp_path), day_first_column="DIA_PRIMERO").records
    ts = parse_ordered_timestamp("FECHA_INICIO_DESPLAZAMIENTO_MOVIL", F.col("DIA_PRIMERO") == "1")
    got = {}
    for r in records.select("NUMERO_INCIDENTE", ts.cast("string").alias("t"), "DIA_PRIMERO").collect():
        got.setdefault((r.NUMERO_INCIDENTE, r.DIA_PRIMERO), set()).add(r.t)
    assert got == {
        ("day.csv", "1"): {"2024-02-25 10:00:00", "2024-02-05 11:00:00", None},
        ("month.csv", "0"): {"2024-02-25 10:00:00", "2024-05-02 11:00:00", "2024-12-31 00:00:00", "2024-03-30 00:00:00"},
        ("silent.csv", "0"): {"2024-05-02 00:00:00", "2024-02-05 00:00:00"},
    }
    (tmp_path / "empty").mkdir()
    assert "DIA_PRIMERO" in C.read_csv_folder(spark, str(tmp_path / "empty"), day_first_column="DIA_PRIMERO").records.columns


def test_only_pieces_of_long_records_are_shuffled(spark, tmp_path, tiny_splits):
    (tmp_path / "a.csv").write_text("NUMERO_INCIDENTE;LOCALIDAD\n" + "".join(f'{i};"x\ny"\n{i};z\n' for i in range(300)), encoding="utf-8")
    records = C.read_csv_folder(spark, str(tmp_path)).records
    assert records.count() == 600
    plan = records._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan  # lines meet in the aggregation of pieces alone
    assert plan.count("Aggregate [path") == 1
