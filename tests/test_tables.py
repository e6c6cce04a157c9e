from weftlink.sources import tables


def test_tsv_round_trip(spark, tmp_path):
    rows = [("S1-1", 'a "quoted" name', "x", None), ("S1-2", "NA", "", "US"), ("S1-3", "plain", "tab", "")]
    p = tmp_path / "in.tsv"
    p.write_text('entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\t"a ""quoted"" name"\tx\t\nS1-2\tNA\t\tUS\n')
    got = [tuple(r) for r in tables.read_tsv(spark, str(p)).orderBy("entity_id").collect()]
    assert got == [("S1-1", 'a "quoted" name', "x", None), ("S1-2", "NA", None, "US")]
    assert tables.read_source(spark, str(p)).filter("business_address = ''").count() == 1
    df = spark.createDataFrame(rows, tables.SOURCE).na.fill("")
    tables.write_tsv(df, str(tmp_path / "out"), "entity_id")
    text = "".join(f.read_text() for f in (tmp_path / "out").glob("part-*"))
    assert text.split("\n")[1] == 'S1-1\t"a ""quoted"" name"\tx\t'


def test_links(spark):
    df = spark.createDataFrame([("a", "x, y,,x"), ("a", "[\"y\";'z,01']"), ("b", None), ("c", "none")], tables.TRUTH)
    assert sorted(map(tuple, tables.links(df).collect())) == [("a", "x"), ("a", "y"), ("a", "z,01")]


def test_store_reuses_only_what_fits(spark, tmp_path):
    store, made = tables.Store(spark, f"file://{tmp_path}"), []

    def make():
        made.append(1)
        return spark.range(3)

    assert store.table("t", {"n": 1}, make).count() == 3 and store.table("t", {"n": 1}, make).count() == 3 and len(made) == 1
    store.table("t", {"n": 2}, make)
    assert len(made) == 2
    store.write_json("best", {"threshold": 0.5})
    assert store.read_json("best") == {"threshold": 0.5}
