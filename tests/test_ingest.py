import os

from pyspark.sql import functions as F

from hirelake.session import scratch_dir
from hirelake.sources.bronze import quarantine_bad_rows, read_bronze
from hirelake.sources.seeds import read_seed
from hirelake.streaming.ingest import ingest_new_files, ingested, landed_stream, load_batch, read_quarantine, read_raw

HEADER = ",".join([
    "source_job_id", "job_title", "url", "company_name", "company_url", "city", "region", "country",
    "employment_type", "workplace_type", "experience_years", "job_category", "industry", "is_salary_disclosed",
    "job_source", "job_posted_date", "job_status", "collected_at", "description"])


def _local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def write_file(path, name, lines, bom=True):
    os.makedirs(_local(path), exist_ok=True)
    with open(os.path.join(_local(path), name), "w", encoding="utf-8-sig" if bom else "utf-8") as f:
        f.write("\n".join([HEADER] + lines) + "\n")


ROW = '{id},Title,https://x/{id},Co,,Riyadh,,Saudi,,,,,,True,Src,,active,2026-01-01 00:00:00,"line one\nsaid ""hi"""'


def test_bom_multiline_quotes_and_empty_as_null(spark):
    land = scratch_dir(spark, "t-bronze")
    write_file(f"{land}/platform=sabbar", "a.csv", [ROW.format(id="J1")])
    r = read_bronze(spark, land).collect()[0]
    assert r.source_job_id == "J1" and r.company_url is None and r.platform == "sabbar"
    assert r.description == 'line one\nsaid "hi"'


def test_new_files_load_once(spark):
    land, table, ckpt = (scratch_dir(spark, x) for x in ("t-land", "t-table", "t-ckpt"))
    assert read_raw(spark, table).count() == 0
    write_file(f"{land}/platform=sabbar", "a.csv", [ROW.format(id="J1"), ROW.format(id="J2")])
    assert ingest_new_files(spark, land, table, ckpt) == 1
    assert ingest_new_files(spark, land, table, ckpt) == 0
    assert read_raw(spark, table).count() == 2
    write_file(f"{land}/platform=tanqeeb", "b.csv", [ROW.format(id="J3"), ROW.format(id="J4").replace("2026-01-01 00:00:00", "soon")])
    ingest_new_files(spark, land, table, ckpt)
    got = read_raw(spark, table).collect()
    assert sorted(r.source_job_id for r in got) == ["J1", "J2", "J3", "J4"] and len({r.row_id for r in got}) == 4
    assert [r.source_job_id for r in ingested(spark, table).where("state = 'undated'").collect()] == ["J4"]
    import hashlib
    assert {r.description_id for r in got} == {hashlib.sha256(b'line one\nsaid "hi"').hexdigest()}


def test_replayed_batch_appends_nothing(spark):
    land, table = scratch_dir(spark, "t-land"), scratch_dir(spark, "t-table")
    write_file(f"{land}/platform=sabbar", "a.csv", [ROW.format(id="J1"), ROW.format(id="J2") + ",surplus"])
    stream = landed_stream(spark, land)
    batch = spark.read.schema(stream.schema).option("header", True).option("multiLine", True).option("escape", '"').option(
        "mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").csv(land)
    for _ in range(2):
        load_batch(batch, 3, table)
    once = sorted(map(str, ingested(spark, table).collect()))
    load_batch(batch, 3, table)
    assert sorted(map(str, ingested(spark, table).collect())) == once and len(once) == 2
    assert read_quarantine(spark, table).count() == 1


def test_bad_rows_are_quarantined(spark):
    land = scratch_dir(spark, "t-quarantine")
    write_file(f"{land}/platform=sabbar", "a.csv", [ROW.format(id="J1"), ROW.format(id="J2") + ",surplus"])
    good, bad = quarantine_bad_rows(spark, land)
    assert [r.source_job_id for r in good.collect()] == ["J1"]
    assert bad.count() == 1


def test_seed_key_must_be_unique(spark):
    path = scratch_dir(spark, "t-seed")
    os.makedirs(_local(path))
    with open(os.path.join(_local(path), "seed.csv"), "w", encoding="utf-8-sig") as f:
        f.write("raw_value_normalized,mapped_city,mapped_region\nRIYADH,Riyadh,\nRIYADH,Riyadh,x\n")
    import pytest
    with pytest.raises(ValueError):
        read_seed(spark, path, key="raw_value_normalized")
    df = read_seed(spark, path)
    assert df.columns[0] == "raw_value_normalized"
    assert df.filter(F.col("mapped_region").isNull()).count() == 1


def test_unreadable_rows_go_to_quarantine(spark, tmp_path):
    land = tmp_path / "land" / "platform=sabbar"
    land.mkdir(parents=True)
    header = ",".join(f"c{i}" for i in range(19))
    good = ",".join(f"v{i}" for i in range(19))
    (land / "a.csv").write_text(f"{header}\n{good}\na,b,c\n{good},extra,fields\n")
    table = str(tmp_path / "t")
    for _ in range(2):  # the second run finds nothing new
        ingest_new_files(spark, str(tmp_path / "land"), table, str(tmp_path / "ckpt"))
    assert read_raw(spark, table).count() == 1
    assert sorted(r[0] for r in read_quarantine(spark, table).select("_corrupt_record").collect()) == sorted(["a,b,c", f"{good},extra,fields"])


def test_platform_from_file_name_only(spark):
    from hirelake.sources.bronze import platform_from_name
    from pyspark.sql import functions as F
    names = ["x_SABBAR.csv", "tanqeeb_gulftalent.csv", "gulftalent.csv", "jadarat-1.csv", "other.csv"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r[0] for r in df.select(platform_from_name(F.col("n"))).collect()] == ["sabbar", "tanqeeb", "golftalent", "jadarat", None]


def _files(path, end):
    return sorted(os.path.join(d, f) for d, _, names in os.walk(_local(path)) for f in names if f.endswith(end))


def test_written_csv_is_compressed_in_bounded_files_without_a_sort(spark, monkeypatch):
    import gzip
    from hirelake.sources import bronze
    monkeypatch.setattr(bronze, "FILE_ROWS", 10)
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key, None)
    out = scratch_dir(spark, "t-csv")
    cols = [F.concat(F.lit(f"{c}\n"), F.col("id").cast("string")).alias(c) for c in HEADER.split(",")]
    df = spark.range(0, 95, 1, 2).select(*cols, F.when(F.col("id") % 3 > 0, F.concat(F.lit("p"), (F.col("id") % 3).cast("string"))).alias("platform"))
    bronze.write_csv(df, out, partition_by=["platform"])
    assert spark.conf.get(key, None) == before
    files = _files(out, ".csv.gz")
    assert len(files) >= 10 and not _files(out, ".csv")
    assert all(gzip.open(f, "rt").read().count("description\n") <= 11 for f in files)
    got = read_bronze(spark, out)
    assert sorted(tuple(r) for r in got.select(*df.columns[:2]).collect()) == sorted(tuple(r) for r in df.select(*df.columns[:2]).collect())
    assert {r[0]: r[1] for r in got.groupBy("platform").count().collect()} == {"p1": 32, "p2": 31, None: 32}


def test_files_of_several_names_land_in_one_pass(spark):
    from hirelake.sources import bronze
    folder = scratch_dir(spark, "t-drop")
    cols = [F.lit("x").alias(c) for c in HEADER.split(",")[1:]]
    names = F.when(F.col("id") < 7, "2026-12-02_a=b jobs").otherwise("2026-12-02_SABBAR_jobs")
    seen = spark.sparkContext.accumulator(0)
    ids = spark.createDataFrame(spark.sparkContext.parallelize(range(10), 1).map(lambda i: (seen.add(1), (i,))[1]), "id long")
    bronze.land_files(ids.select(F.col("id").cast("string").alias("source_job_id"), *cols, names.alias("__file")), folder, "__file")
    assert seen.value == 10
    assert [os.path.basename(f) for f in _files(folder, ".gz")] == ["2026-12-02_SABBAR_jobs-0.csv.gz", "2026-12-02_a=b jobs-0.csv.gz"]
    got = read_bronze(spark, folder, with_platform=False)
    assert sorted(int(r.source_job_id) for r in got.select("source_job_id").collect()) == list(range(10))
    routed = bronze.route_by_platform(spark, folder, scratch_dir(spark, "t-routed"))
    assert {r[0]: r[1] for r in routed.groupBy("platform").count().collect()} == {None: 7, "sabbar": 3}
