"""File scans, with small files written here."""

import json
import random

import pytest
from pyspark.sql import functions as F

from winnow.functions import scalars as S
from winnow.sources import catalog, product, records, stages


def test_log(spark, tmp_path):
    log = "commit=a1\nauthor_name=Ann\nauthor_email=a@x\nauthor_time=1700000000\ncommit_time=oops\nparents=p q\nsubject=net: fix\nbody=first\nsecond line\x1f\n1\t2\tnet/a.c\n-\t-\tlogo.png\nnet/b.c\n\x1e\n\n\x1ecommit=b2\nsubject=two\nbody=\x1e"
    (tmp_path / "log.txt").write_text(log)
    a, b = records.read_log(spark, str(tmp_path / "log.txt")).orderBy("seq").collect()
    assert (a.record_id, a.subject, a.body, a.author_time, a.commit_time) == ("a1", "net: fix", "first second line", 1700000000, 0)
    assert a.parents == ["p", "q"] and a.files == ["logo.png", "net/a.c", "net/b.c"]
    assert [tuple(x) for x in a.numstat] == [("1", "2", "net/a.c"), ("-", "-", "logo.png")]
    assert (b.record_id, b.body, b.files, b.author_time) == ("b2", "", [], 0)
    df = records.read_log(spark, str(tmp_path / "log.txt"))
    assert {(r.record_id, r.n_files, r.added, r.deleted, r["binary"]) for r in records.numstat_rollup(df).collect()} == {("a1", 3, 1, 2, 1), ("b2", 0, 0, 0, 0)}
    assert records.without_merges(df).count() == 1


@pytest.mark.parametrize("seed", range(3))
def test_first_parents(spark, seed):
    r = random.Random(seed)
    up = {i: [f"c{j}" for j in r.sample(range(i + 1, min(i + 6, 44)), r.randint(0, min(2, min(i + 5, 43) - i)))] or [f"c{i + 1}"] * (i % 9 > 0) for i in range(40)}
    rows = spark.createDataFrame([(f"c{i}", i, p) for i, p in up.items()] + [("c3", 99, ["c0"]), (None, 100, ["c1"])], "record_id string, seq int, parents array<string>")
    for head in (0, 7):
        on, want = head, set()
        while on in up:
            want.add(f"c{on}")
            on = int(up[on][0][1:]) if up[on] else None
        got = [x.record_id for x in records.first_parents(rows, f"c{head}" if head else None).collect()]
        assert set(got) == want and len(got) == len(want) + ("c3" in want)
    assert records.first_parents(rows, "none").count() == 0 and records.first_parents(rows.limit(0)).count() == 0
    loop = spark.createDataFrame([("a", 0, ["b"]), ("b", 1, ["c"]), ("c", 2, ["b"])], rows.schema)
    assert records.first_parents(loop).count() == 3


def test_config(spark, tmp_path):
    p = tmp_path / "config"
    p.write_text("CONFIG_A=y\n# CONFIG_B is not set\nCONFIG_C=m\nCONFIG_A=m\nCONFIG_D=\"x\"\n  CONFIG_E=y\nnoise\n")
    got = {(r.symbol, r.value, r.enabled) for r in product.read_config(spark, str(p)).collect()}
    assert got == {("CONFIG_A", "m", True), ("CONFIG_B", None, False), ("CONFIG_C", "m", True), ("CONFIG_D", '"x"', True), ("CONFIG_E", "y", True)}
    assert {r.symbol for r in product.enabled_symbols(spark.read.text(str(p))).collect()} == {"CONFIG_A=y", "CONFIG_C=m", "CONFIG_A=m", "CONFIG_E=y"}


def test_makefiles(spark, tmp_path):
    (tmp_path / "drivers/usb").mkdir(parents=True)
    (tmp_path / "drivers/usb/Makefile").write_text("# obj-$(CONFIG_NO) += no.o\nobj-$(CONFIG_USB) += core.o hub.o dir/\nobj-y += always.o\nobj-$(call x,$(CONFIG_LAST)) := last.o\n")
    (tmp_path / "Kbuild").write_text("obj-$(CONFIG_TOP) = ./top.o\n")
    (tmp_path / "Makefile.inc").write_text("obj-$(CONFIG_INC) += inc.o\n")
    got = {(r.symbol, r.path) for r in product.read_makefiles(spark, str(tmp_path)).collect()}
    assert got == {("CONFIG_USB", "drivers/usb/core.c"), ("CONFIG_USB", "drivers/usb/hub.c"), ("CONFIG_LAST", "drivers/usb/last.c"), ("CONFIG_TOP", "top.c")}
    assert product.kbuild_files(spark, str(tmp_path)).count() == 2


def test_logs_artifacts_hints(spark, tmp_path):
    (tmp_path / "log").write_text("  CC drivers/a.o\n  LD [M] net/b.ko   \nnothing.oo\n")
    assert {r.name for r in product.read_build_logs(spark, [str(tmp_path / "log")]).collect()} == {"a.o", "b.ko"}
    (tmp_path / "out/x").mkdir(parents=True)
    (tmp_path / "out/x/m.ko").write_bytes(b"1")
    (tmp_path / "out/n.o").write_bytes(b"1")
    (tmp_path / "out/x/empty 1+1%.o").write_bytes(b"")
    (tmp_path / "out/x/m.c").write_bytes(b"1")
    assert {r.path for r in product.read_artifacts(spark, str(tmp_path / "out")).collect()} == {"x/m.ko", "n.o", "x/empty 1+1%.o"}
    (tmp_path / "hints.json").write_text(json.dumps({"usb": ["drivers/usb", "include/usb"], "net": "net", "// note": ["x"]}, indent=1))
    assert {(r.keyword, r.prefix) for r in product.read_hints(spark, str(tmp_path / "hints.json")).collect()} == {("usb", "drivers/usb"), ("usb", "include/usb"), ("net", "net")}


def test_catalog(spark, tmp_path):
    for folder, rule, text in (("rules", "usb", "usb # bus\n\n# all\nxhci\n"), ("more", "usb", "other\n"), ("more", "net", "skb\n")):
        (tmp_path / folder / rule).mkdir(parents=True)
        (tmp_path / folder / rule / "keywords_whitelist.txt").write_text(text)
    (tmp_path / "profiles").mkdir()
    (tmp_path / "profiles/one.json").write_text('{ // first\n "name": "one", "description": "d", "rules": {"usb": 70, "x:net": {"weight": 20, "path_whitelist_extra": ["net/*"]}}}')
    (tmp_path / "profiles/two.json").write_text('# second\n{"rules": {"usb": {}}}')
    (tmp_path / "profiles/two.json").write_text('# second\n{"description": "see https://x # y", "rules": {"usb": {}}}')
    read = lambda: catalog.read_catalog(spark, str(tmp_path / "rules"), str(tmp_path / "profiles"), str(tmp_path / "more"))
    c = read()
    assert [p[1] for p in c.profiles] == ["d", "see https://x # y"]
    assert c.names() == ["one", "two"] and dict(c.rules_of("one")) == {"usb": 70, "x:net": 20} and c.rules_of("two") == [("usb", 50)]
    assert c.of_rule("usb", "keywords_whitelist") == ["usb", "xhci"] and c.of_rule("x:net", "keywords_whitelist") == ["skb"]
    assert c.of_rule("x:net", "path_whitelist") == ["net/*"]
    assert catalog.catalog_problems(c) == []
    bad = catalog.Catalog([("p", "", 120.0, 0)], [("p", "r", 1, 0)], [("q", "keywords_whitelist", 0, "re:(")])
    assert {x[0] for x in catalog.catalog_problems(bad)} == {"weight_range", "empty_rule", "invalid_regex"}
    (tmp_path / "profiles/three.json").write_text("no profile")
    with pytest.raises(ValueError, match="three"):
        read()
    (tmp_path / "profiles/three.json").write_text('{"name": "one", "rules": {}}')
    with pytest.raises(ValueError, match="collision.*one"):
        read()
    (tmp_path / "profiles/three.json").write_text("{}")
    (tmp_path / "rules/deep/usb").mkdir(parents=True)
    (tmp_path / "rules/deep/usb/path_whitelist.txt").write_text("x/*")
    with pytest.raises(ValueError, match="collision.*usb"):
        read()
    frames = c.frames(spark)
    assert catalog.fingerprint(*frames).first()[0] == catalog.fingerprint(*[f.orderBy(F.rand(1)) for f in frames]).first()[0]


def test_stage_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    assert records.stage_table(spark, path, "a int").collect() == []
    spark.range(3).selectExpr("cast(id as int) a").write.parquet(path)
    assert records.stage_table(spark, path, "a int").count() == 3


def test_written_steps(spark, monkeypatch):
    written = stages.cut(spark.range(10).repartition(3), "ten")
    assert written.count() == 10 and written.cut_path.startswith(stages.session_dir(spark) + "/ten")
    stages.discard(written)
    with pytest.raises(Exception, match="(?i)exist"):
        spark.read.parquet(written.cut_path)
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"

    class Elsewhere:
        conf = {}
        sparkContext = type("Context", (), {"master": "spark://far:7077", "getCheckpointDir": lambda self: None})()

    with pytest.raises(ValueError, match="checkpoint"):
        stages.shared_dir(Elsewhere())


def test_writes_of_several_threads(spark):
    """Two writes of one session leave its settings as they were, in whatever order they end."""
    from concurrent.futures import ThreadPoolExecutor

    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    with ThreadPoolExecutor(4) as pool:
        tables = list(pool.map(lambda n: stages.cut(spark.range(200 * n).groupBy((F.col("id") % 7).alias("k")).count(), "many"), range(1, 7)))
    assert [sorted({r["count"] for r in t.collect()})[-1] for t in tables] == [-(-200 * n // 7) for n in range(1, 7)]
    assert spark.conf.get(key) == "false" and not stages._writing


def test_scalars(spark):
    paths = ["a/b/c.tar.gz", "x", "a/.hidden", "a.b/c", ".x.y", "dir/", ""]
    import os.path as op

    df = spark.createDataFrame([(p,) for p in paths], "p string")
    for r in df.select("p", S.dirname(F.col("p")).alias("d"), S.basename(F.col("p")).alias("b"), S.stem(F.col("p")).alias("s"), S.ancestors(F.col("p")).alias("a")).collect():
        assert (r.d, r.b, r.s) == (op.dirname(r.p), op.basename(r.p), op.splitext(r.p)[0])
    times = spark.createDataFrame([("1700000000",), ("0",), ("",), (None,), ("2020-01-01 10:20:30",)], "t string")
    assert [r[0] for r in times.select(S.minute_text(F.col("t"))).collect()] == ["2023-11-14 22:13", "", "", "", "2020-01-01 10:20"]
    build = spark.createDataFrame([(p,) for p in ("x/Makefile", "Kconfig.debug", "a.mk", ".mk", "Kbuild", "a.c")], "p string")
    assert [r[0] for r in build.select(S.is_build_file(F.col("p"))).collect()] == [True, True, True, False, True, False]
