"""Core operators against small tables and plain Python."""

import hashlib
import json
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from brightseam import schemas
from brightseam.errors import ContractError, MissingInputError
from brightseam.functions import dirt, ranking, scalars
from brightseam.operators import audit, cluster, components, embed, neardup, reports, review, signatures, split
from brightseam.sources import files, images, sinks


def png(x, filters=(0, 1, 2, 3, 4)):
    """A PNG of (height, width, channels) bytes, its lines filtered in turn."""
    h, w, n = x.shape
    body = b""
    for y in range(h):
        kind = filters[y % len(filters)]
        left = np.vstack((np.zeros((1, n), int), x[y, :-1])).astype(int)
        up = x[y - 1].astype(int) if y else np.zeros((w, n), int)
        corner = np.vstack((np.zeros((1, n), int), up[:-1]))
        p = left + up - corner
        a, b, c = abs(p - left), abs(p - up), abs(p - corner)
        guess = [0 * left, left, up, (left + up) // 2, np.where((a <= b) & (a <= c), left, np.where(b <= c, up, corner))][kind]
        body += bytes([kind]) + ((x[y].astype(int) - guess) & 255).astype(np.uint8).tobytes()
    chunk = lambda k, d: len(d).to_bytes(4, "big") + k + d + zlib.crc32(k + d).to_bytes(4, "big")
    head = w.to_bytes(4, "big") + h.to_bytes(4, "big") + bytes([8, {1: 0, 2: 4, 3: 2, 4: 6}[n], 0, 0, 0])
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(body)) + chunk(b"IEND", b"")


def scene(seed, side=96):
    """A smooth picture."""
    g = np.random.default_rng(seed)
    x = np.kron(g.integers(0, 256, (6, 6, 3)), np.ones((side // 6, side // 6, 1)))
    return images.resize(images.resize(x.astype(np.uint8), 12, 12), side, side)


def test_pictures(spark):
    g = np.random.default_rng(1)
    for n in (1, 2, 3, 4):
        x = g.integers(0, 256, (11, 9, n)).astype(np.uint8)
        want = x[:, :, :3] if n > 2 else np.repeat(x[:, :, :1], 3, axis=2)
        assert np.array_equal(images.rgb(png(x)), want) and images.verified_size(png(x)) == (9, 11)
    with pytest.raises(ValueError):
        images.verified_size(png(x)[:-20])
    flat = np.full((40, 30), 77, np.uint8)
    assert np.array_equal(images.resize(flat, 8, 9), np.full((9, 8), 77)) and np.array_equal(images.resize(flat, 30, 40), flat)
    ramp = np.tile(np.arange(0, 256, 4, dtype=np.uint8), (64, 1))
    assert signatures.gradient_hash(ramp) == "f" * 16 and signatures.gradient_hash(ramp[:, ::-1]) == "0" * 16 and signatures.wavelet_hash(ramp) == "0f" * 8
    a = scene(3)
    b = np.clip(a.astype(int) + g.integers(-3, 4, a.shape), 0, 255).astype(np.uint8)
    df = spark.createDataFrame([("a", png(a)), ("b", png(b)), ("c", png(scene(4))), ("d", b"junk")], "path string, content binary")
    s = {r["path"]: r for r in signatures.image_signatures(df).collect()}
    far = lambda x, y: [bin(int(s[x][h], 16) ^ int(s[y][h], 16)).count("1") for h in neardup.HASHES]
    assert sum(d <= 4 for d in far("a", "b")) >= 2 and sum(d <= 4 for d in far("a", "c")) < 2
    assert s["d"]["phash"] is None and "identify" in s["d"]["hash_error"]


def test_bands_lose_no_pair(spark):
    """Against all pairs compared, with other limits and votes too."""
    g = random.Random(2)
    rows = []
    for i in range(300):
        base = rows[g.randrange(len(rows))][1:] if rows and g.random() < 0.7 else [g.getrandbits(64) | 0xFFFF << 48 for _ in range(3)]
        rows.append((i, *[h ^ sum(1 << g.randrange(48) for _ in range(g.randint(0, 3))) for h in base]))
    df = spark.createDataFrame([(i, f"p{i}", "0", "c", f"s{i % 290}", *[f"{h & (1 << 64) - 1:016x}" for h in hs]) for i, *hs in rows], "ord int, path string, label string, class_name string, sha256 string, phash string, dhash string, whash string")
    have = df.collect()
    for limit, votes in ((4, 2), (2, 1), (6, 3)):
        got = [(r["path_a"], r["path_b"]) for r in neardup.near_pairs(df, 4, limit, votes).collect()]
        d = lambda a, b: [bin(int(a[h], 16) ^ int(b[h], 16)).count("1") <= limit for h in neardup.HASHES]
        want = {(a["path"], b["path"]) for a in have for b in have if a["ord"] < b["ord"] and a["phash"][:4] == b["phash"][:4] and a["sha256"] != b["sha256"] and sum(d(a, b)) >= votes}
        assert len(got) == len(set(got)) and set(got) == want and want


def test_numbers_over_many_ranges(spark):
    df = spark.createDataFrame([(x, i) for i, x in enumerate([5, None, 3, 10**15, 7, 7] * 40)], "v bigint, i int")
    got = [r["k"] for r in components.number_by(df, ["v", "i"], "k", rows_per_task=30).orderBy("v", "i").collect()]
    assert got == list(range(1, 241))


def col(spark, values, f, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[1] for r in df.select("i", f(F.col("v"))).orderBy("i").collect()]


def test_dirty_values(spark):
    assert col(spark, [" 0", "00", "1.0", "ORGANIC", "0_Recyclable", "9", "", None, "2 ", "0_Organic"], dirt.class_label) == ["0", "0", "1", "2", "0", None, None, None, "2", None]
    assert col(spark, ["640", "640.0", "640px", "1,024", "-3", "nan", "?", "0", None, "1e3"], dirt.positive_number) == [640, 640, 640, 1024, None, None, None, None, None, 1000]
    a = "train/0_Recyclable/R_a b.jpg"
    spelled = [a, "./train/0_Recyclable/R_a b.jpg", "train\\0_Recyclable\\R_a b.jpg", "train//0_Recyclable/./R_a b.jpg", "TRAIN/0_recyclable/r_A B.jpg\n", " train/0%5FRecyclable/R_a%20b.jpg", "file:///x/y/train/0_Recyclable/R_a b.jpg", "/q/" + a]
    assert set(col(spark, spelled, dirt.image_key)) == {a.lower()}
    assert col(spark, ["%zz", None, "", "x+y"], dirt.image_key) == ["%zz", None, "", "x+y"]
    h = "AB" * 32
    assert col(spark, [h, "sha256:" + h, " " + h, h[:-1], None, "SHA256=" + h], dirt.sha256_digest) == [h.lower(), h.lower(), h.lower(), None, None, h.lower()]
    names = ["t/0/R_bk07_000001_5.jpg", "t/0/thumb_R_bk07-00001-v2.jpg", "t/0/R_20260419_bk07_000012_0.jpg", "t/0/R.Bk07.12.003.png", "t/0/R_bk07000012s3.jpeg", "t/0/R_bk07_obj12_1.webp", "t/0/odd.jpg", None]
    assert col(spark, names, dirt.object_entity) == ["bk07-1", "bk07-1", "bk07-12", "bk07-12", "bk07-12", "bk07-12", None, None]
    assert col(spark, ["C7", "c007", "cluster 7", " 7", "-1", "?", None, "C123"], dirt.cluster_name) == ["C07", "C07", "C07", "C07", None, None, None, "C123"]
    assert col(spark, ["1", "True", " 1", "1.0", "0", "", None], dirt.flag) == [True] * 4 + [False] * 3


def test_spread_row_number_equals_one_window(spark):
    rows = [(random.Random(i).randint(0, 3), i) for i in range(500)] + [(None, 900), (None, 901)]
    df = spark.createDataFrame(rows, "g int, i int").withColumn("u", ranking.unit_hash("i"))
    got = {(r["g"], r["i"]): r["k"] for r in ranking.spread_row_number(df, ["g"], ["i"], "k", rows_per_task=20, u="u").collect()}
    for g in (0, 1, 2, 3, None):
        own = sorted(((r["u"], r["i"]) for r in df.where(F.col("g").eqNullSafe(F.lit(g))).collect()))
        assert [got[g, i] for _, i in own] == list(range(1, len(own) + 1))


def test_scalars(spark):
    df = spark.createDataFrame([(0.3203125, 5.0, float("nan"))], "a double, n double, z double")
    r = df.select(scalars.fixed6(F.col("a")), scalars.fixed6(F.col("z")), scalars.fixed6(F.lit(None).cast("double")), scalars.bankers_target(F.lit(5), 0.5), scalars.padded_id("G", F.lit(123456), 5), scalars.ratio6(F.lit(1), F.lit(0))).first()
    assert list(r) == ["0.320312", "nan", "", 2, "G123456", None]
    assert col(spark, ["f" * 16, "0" * 16], lambda c: scalars.hamming(scalars.bits(c), F.lit(0).cast("bigint"))) == [64, 0]
    with pytest.raises(Exception, match="unknown decision"):
        spark.createDataFrame([("x",)], "d string").select(*scalars.action_columns(F.col("d"), F.lit("a"), F.lit("b"))).collect()


def brute(edges):
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {x: find(x) for x in up}


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(f"n{rng.randint(0, 60):02d}", f"n{rng.randint(0, 60):02d}") for _ in range(45)] + [(f"p{i:02d}", f"p{i + 1:02d}") for i in range(20)]
    got = dict(map(tuple, components.connected_components(spark.createDataFrame(edges, "left string, right string")).collect()))
    assert got == brute(edges)
    assert components.connected_components(spark.createDataFrame([], "left string, right string")).count() == 0


@pytest.mark.parametrize("target", [0, 7, 40, 10_000])
def test_first_fit(spark, target):
    rng = random.Random(target)
    rows = [(f"G{i:05d}", rng.choice([1, 1, 1, 2, 3, 9, 14]), rng.random()) for i in range(60)]
    got = {r[0] for r in split.first_fit(spark.createDataFrame(rows, "group_id string, group_size bigint, draw double"), target).collect()}
    left, want = target, set()
    for g, n, _ in sorted(rows, key=lambda r: r[2]):
        if n <= left:
            want.add(g)
            left -= n
    rest = sorted((abs(n - left), g) for g, n, _ in rows if g not in want)
    if left and rest and rest[0][0] < left:
        want.add(rest[0][1])
    assert got == want


def test_review(spark):
    rows = spark.createDataFrame([("1", "a", "0", "x", " 1", ""), ("2", "a", "0", "x", "0", ""), ("3", "b", "5", "x", "7", None), ("4", " ", None, "x", "2", "why")], "image_id string, path string, current_label string, class_name string, review_status string, reason string")
    e = {(r["rule"], r["path"]): r["n"] for r in review.review_errors(rows, spark.createDataFrame([("a",), ("c",)], "path string")).collect()}
    assert e == {("blank_path", ""): 1, ("bad_status", "b"): 1, ("duplicate_path", "a"): 2, ("unknown_path", "b"): 1, ("unreviewed_path", "c"): 1, ("missing_reason", "a"): 1}
    with pytest.raises(ContractError, match="unreviewed_path: c"):
        review.require_no_errors(review.review_errors(rows, spark.createDataFrame([("a",), ("c",)], "path string")), "bad")
    assert review.status_manifest(rows, "remove").count() == 1
    fixed = review.apply_overrides(rows, spark.createDataFrame([("b", "1", "told")], "path string, review_status string, reason string"))
    assert fixed.where("review_status = '1' and reason = 'told'").count() == 1
    acts = spark.createDataFrame([("f9", "exact", "a", "a", "b", "", 0), ("f2", "exact", "b", "b", "a", "", 1), ("f3", "near", "both", "", "", "x|y", 2), ("f10", "exact", "a", "a", "b", "", 3)], "folder string, type string, decision string, keep_path string, remove_path string, group_paths string, _ord bigint")
    assert {r["path"]: r["source_folder"] for r in review.last_removal(acts).collect()} == {"a": "f2", "b": "f10"}
    kept = rows.where("trim(path) <> ''").dropDuplicates(["path"])
    assert review.clean_manifest(kept, acts).count() == 0 and review.removed_manifest(kept, acts).count() == 2
    assert [tuple(r)[1:3] for r in review.group_pairs(acts).collect()] == [("x", "y")]


def test_audit_and_near(spark):
    df = spark.createDataFrame([(1, "t"), (2, "t"), (3, None), (4, "u")], "i int, t string").withColumn("s", F.sha2("t", 256))
    assert [tuple(r)[1:] for r in audit.exact_groups(df, "s", "i", "i").collect()] == [(2, "1|2")]
    items = [(1, "a", "0", "c", "s1", "00000000000000ff", "0" * 16, "0" * 16), (2, "b", "1", "c", "s2", "00000000000000fe", "000000000000000f", "f" * 16), (3, "c", "1", "c", "s2", None, None, None), (4, "d", "1", "c", "s1", "00000000000000ff", "0" * 16, "0" * 16), (5, "e", "0", "c", "s3", "f" * 16, "0" * 16, "0" * 16)]
    i = spark.createDataFrame(items, "ord int, path string, label string, class_name string, sha256 string, phash string, dhash string, whash string")
    got = {(r["path_a"], r["path_b"], r["matching_hashes"], r["cross_label"]) for r in neardup.near_pairs(i).collect()}
    assert got == {("a", "b", 2, "True"), ("b", "d", 2, "False")}
    v = spark.createDataFrame([(1, [float(x) for x in range(64)]), (2, None)], "i int, v array<float>")
    assert {tuple(r) for r in neardup.vector_signatures(v, "i", "v").collect()} == {(1, "00000000ffffffff", "fffffffffffffffe", "7fffffffffffffff"), (2, None, None, None)}


def test_reports(spark):
    a = spark.createDataFrame([("p1", "0", "C00", "0.100000", "train", 1), ("p2", "1", "C00", "0.300000", "train", 2), ("p3", "0", "C00", "0.200000", "train", 3), ("p4", "1", "C01", "0.5", "val", 4)], "path string, label string, cluster_id string, distance_to_centroid string, split string, _ord bigint")
    spine = spark.createDataFrame([("C00",), ("C01",), ("C02",)], "cluster_id string")
    s = {r["cluster_id"]: r for r in reports.cluster_summary(a.where("split = 'train'"), a.where("split = 'val'"), spine).collect()}
    assert (s["C00"]["dominant_train_label"], s["C00"]["label_entropy"], s["C00"]["assigned_centroid_distance_median"]) == ("0", "0.636514", "0.200000")
    assert (s["C02"]["train_count"], s["C02"]["dominant_train_label"], s["C02"]["label_entropy"]) == (0, "", "0.000000")
    c = {r["cluster_id"]: r["coverage_note"] for r in reports.validation_coverage(a.where("split = 'train'"), a.where("split = 'val'"), spine).collect()}
    assert c == {"C00": "missing_in_val", "C01": "ok", "C02": "missing_in_val"}
    r = reports.representatives(a, 1)
    assert {(x["path"], x["representative_type"]) for x in r.where("split = 'train'").collect()} == {("p1", "nearest"), ("p2", "farthest")}
    assert reports.representatives(a, 0).count() == 0
    tied = reports.representatives(a.withColumn("distance_to_centroid", F.lit("0.5")).withColumn("_ord", 9 - F.col("_ord")), 1).where("split = 'train'").collect()
    assert {(x["path"], x["representative_type"]) for x in tied} == {("p3", "nearest"), ("p1", "farthest")}  # ties by place, not by path
    assert reports.macro_f1(spark.createDataFrame([("0", "0"), ("1", "0")], "truth string, guess string"), ["0", "1", "2"]).first()[0] == pytest.approx(0.222222)


def test_clusters(spark):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(8 * (i % 3), 1), rng.gauss(0, 1)], i % 3) for i in range(120)]
    df = spark.createDataFrame(rows, "i int, v array<double>, c int")
    d = cluster.k_diagnostics(df, "i", "v", [2, 3], [1, 2], tiny=3)
    assert cluster.select_k(d).first()["k"] == 3
    with pytest.raises(ContractError):
        cluster.k_diagnostics(df, "i", "v", [1], [1])
    assert 0.5 < cluster.silhouette(df, "i", "v", "c") <= 1
    two = df.select("c", (2 - F.col("c")).alias("d"))
    assert cluster.adjusted_rand(two, "c", "d").first()[0] == 1.0
    lone = df.select(F.lit(0).alias("c"), F.lit(0).alias("d"))
    assert cluster.adjusted_rand(lone, "c", "d").first()[0] == 1.0


def test_files(spark, tmp_path):
    m = spark.createDataFrame([("1", 'tr"a,in/a', "0", "x", "0", None), ("2", "line\nbreak", "1", "y", "1", "")], "image_id string, path string, current_label string, class_name string, review_status string, reason string")
    out = str(tmp_path / "m")
    sinks.write_table(m, out, "manifest", order=["image_id"])
    back = files.read_manifest(spark, out, "manifest", order=True, exact_header=True)
    assert [tuple(r)[:6] for r in back.orderBy("_ord").collect()] == [("1", 'tr"a,in/a', "0", "x", "0", ""), ("2", "line\nbreak", "1", "y", "1", "")]
    with pytest.raises(MissingInputError):
        files.read_manifest(spark, str(tmp_path / "none"), "manifest")
    with pytest.raises(ContractError):
        files.read_manifest(spark, out, "review_batch")
    (tmp_path / "train" / "0_x").mkdir(parents=True)
    (tmp_path / "train" / "0_x" / "a.png").write_bytes(b"\x89PNG\r\n\x1a\n" + b"\0\0\0\rIHDR" + (7).to_bytes(4, "big") + (5).to_bytes(4, "big"))
    (tmp_path / "train" / "0_x" / "c.png").write_bytes(png(np.zeros((5, 7, 3), np.uint8)))
    (tmp_path / "train" / "0_x" / "b.jpg").write_bytes(b"junk")
    assert {r[0] for r in files.list_files(spark, str(tmp_path / "train")).collect()} == {"train/0_x/a.png", "train/0_x/b.jpg", "train/0_x/c.png"}
    raw = files.read_bytes(spark, str(tmp_path / "train/*/*"))
    info = {r["path"]: (r["width"], r["height"]) for r in files.image_info(raw).collect()}
    assert info["train/0_x/a.png"] == (None, None) and info["train/0_x/c.png"] == (7, 5)  # the first ends in its header
    assert info["train/0_x/b.jpg"] == (None, None)
    assert {r["path"]: r["sha256"] for r in files.image_info(raw).collect()}["train/0_x/b.jpg"] == hashlib.sha256(b"junk").hexdigest()
    many = spark.range(1000).select(*[F.lit("x").alias(c) if c != "image_id" else F.col("id").cast("string").alias(c) for c in schemas.MANIFEST], "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    sinks.write_table(many.repartition(7), str(tmp_path / "many"), "manifest", order=["id"])
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(list((tmp_path / "many").glob("part-*"))) > 1
    placed = files.read_manifest(spark, str(tmp_path / "many"), "manifest", order=True).collect()
    assert sorted((int(r["image_id"]), r["_ord"]) for r in placed) == [(i, i) for i in range(1000)]
    assert sinks.copy_images(spark.createDataFrame([("exact/1/a.jpg", b"x"), ("exact/1/b.jpg", b"y")], "name string, content binary"), str(tmp_path / "copies")) == 2
    assert (tmp_path / "copies/exact/1/b.jpg").read_bytes() == b"y"
    queue = spark.createDataFrame([("f", "a", "", "")], "folder string, decision string, guide string, notes string")
    sinks.replace_queue(queue, str(tmp_path / "q"))
    with pytest.raises(ContractError, match="decisions"):
        sinks.replace_queue(queue, str(tmp_path / "q"))


def test_embed(spark):
    rows = spark.createDataFrame([(i * 3, i % 4 != 0) for i in range(50)], "o bigint, ok boolean")
    got = {r["o"]: r["row_no"] for r in embed.number_valid(rows, "ok", "o").collect()}
    want = {o: k for k, o in enumerate(i * 3 for i in range(50) if i % 4)}
    assert got == want | {i * 3: None for i in range(50) if i % 4 == 0}
    img = spark.createDataFrame([("a", b"xy"), ("b", b"")], "path string, content binary")
    out = {r["path"]: r for r in embed.extract(img, lambda: lambda c: [1.0 / len(c)]).collect()}
    assert out["a"]["embedding"] == [0.5] and "ZeroDivisionError" in out["b"]["embedding_error"]
    s = {r["state"]: r["n"] for r in embed.cache_state(img, spark.createDataFrame([("a",), ("z",)], "path string")).collect()}
    assert s == {"cached": 1, "missing": 1, "stale": 1}


def test_entry_has_sql_for_each_name():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())


def test_command_line(spark, tmp_path):
    from brightseam import cli

    out = str(tmp_path)
    m = [(str(i), f"train/x/{i}", str(i % 2), "c", "0", "") for i in range(40)]
    sinks.write_table(spark.createDataFrame(m, "image_id string, path string, current_label string, class_name string, review_status string, reason string"), f"{out}/m", "manifest")
    sinks.write_table(spark.createDataFrame([("s", "2", "train/x/0|train/x/2")], "sha256 string, count string, paths string"), f"{out}/e", "exact_duplicates")
    pairs = spark.createDataFrame([("f", "train/x/1", "train/x/3", "r")], "source_folder string, path_a string, path_b string, reason string")
    sinks.write_table(pairs, f"{out}/g", "dedup_group_pairs")
    near = spark.createDataFrame([("train/x/3", "train/x/1")], "path_a string, path_b string")
    for c in ("label_a", "class_a", "label_b", "class_b", "phash_distance", "dhash_distance", "whash_distance", "matching_hashes", "cross_label"):
        near = near.withColumn(c, F.lit("False"))
    sinks.write_table(near, f"{out}/n", "near_duplicate_pairs")
    args = ["split", "--manifest", f"{out}/m", "--exact-duplicates", f"{out}/e", "--group-pairs", f"{out}/g", "--near-pairs", f"{out}/n", "--out", f"{out}/split"]
    cli.main(args)
    got = {s: {r["path"] for r in files.read_manifest(spark, f"{out}/split/{s}_manifest", "manifest").collect()} for s in ("train", "val")}
    assert len(got["val"]) == 8 and len(got["train"]) == 32
    for a, b in ((0, 2), (1, 3)):
        assert (f"train/x/{a}" in got["val"]) == (f"train/x/{b}" in got["val"])
    cli.main(["prepare-review", "--exact", f"{out}/e", "--near", f"{out}/n", "--out", f"{out}/r"])
    assert files.read_manifest(spark, f"{out}/r/duplicate_review", "duplicate_review").count() == 2
    rng = random.Random(1)
    for s, n in (("train", 60), ("val", 20)):
        spark.createDataFrame([(f"{s}{i}", str(i % 3), [rng.gauss(9 * (i % 3), 1), rng.gauss(0, 1)]) for i in range(n)], "path string, label string, embedding array<double>").write.parquet(f"{out}/{s}v")
    cli.main(["cluster-diagnostics", "--train", f"{out}/trainv", "--val", f"{out}/valv", "--candidate-k", "2,3", "--final-n-init", "2", "--tiny-cluster-threshold", "3", "--out", f"{out}/c"])
    assert files.read_manifest(spark, f"{out}/c/cluster_summary", "cluster_summary").count() == 3


def test_queries_keep_every_label(spark, tmp_path):
    """Readable labels count as their class, unreadable ones as one of their own; no query drops a path for its label."""
    from brightseam.plans import queries

    labels = ["0", "0.0", " 2", "Organic", "1_Electronic", "?", None, "7"] * 5
    rows = [(str(i), f"t/{i:02d}", x, "c", "0", "") for i, x in enumerate(labels)]
    out = str(tmp_path)
    tables = {
        "manifest_clean": (rows, "image_id string, path string, current_label string, class_name string, review_status string, reason string"),
        "duplicate_review_actions": ([("f", "exact", "a", "t/00", "t/05", "")], "folder string, type string, decision string, keep_path string, remove_path string, group_paths string"),
        "exact_duplicates": ([("s", "2", "t/01|t/07")], "sha256 string, count string, paths string"),
        "dedup_group_pairs": ([("f", "t/02", "t/03", "r")], "source_folder string, path_a string, path_b string, reason string"),
        "near_duplicate_pairs": ([("t/00", "t/06"), ("t/02", "t/03")], "path_a string, path_b string"),
    }
    for name, (own, schema) in tables.items():
        spark.createDataFrame(own, schema).write.parquet(f"{out}/{name}.parquet")
    q = {k: [r.asDict() for r in queries.queries()[k](spark, out).collect()] for k in ("clean_manifest", "removed_manifest", "unsafe_near_pairs", "retained_edges", "component_groups", "mixed_label_groups", "split_mixed_bernoulli", "val_targets", "train_manifest", "val_manifest", "edge_accounting")}
    assert {r["path"]: r["current_label"] for r in q["clean_manifest"]} == {p: x for _, p, x, *_ in rows if p != "t/05"}
    assert [(r["path"], r["label"]) for r in q["removed_manifest"]] == [("t/05", "?")]
    assert [(r["lo"], r["hi"]) for r in q["unsafe_near_pairs"]] == [("t/00", "t/06")]
    assert {(r["left"], r["right"]) for r in q["retained_edges"]} == {("t/01", "t/07"), ("t/02", "t/03")}
    assert {r["kind"]: r["n"] for r in q["edge_accounting"]}["near_duplicate_pairs_retained"] == 2
    assert sum(r["group_size"] for r in q["component_groups"]) == 40 and sum(r["n0"] + r["n1"] + r["n2"] for r in q["component_groups"]) == 25
    assert not q["mixed_label_groups"] and len(q["split_mixed_bernoulli"]) == 1  # 0.0 with 7: one class, and one without a readable label
    assert {r["label"]: (r["n"], r["target"]) for r in q["val_targets"]} == {"0": (10, 2), "1": (5, 1), "2": (10, 2), "unreadable": (15, 3)}
    want = ["0", "0", "2", "2", "1", "unreadable", "unreadable", "unreadable"] * 5
    assert sorted((r["path"], r["label"]) for r in q["train_manifest"] + q["val_manifest"]) == [(f"t/{i:02d}", x) for i, x in enumerate(want)]
    assert any(r["label"] == "unreadable" for r in q["val_manifest"])


def test_whole_chain(spark, tmp_path):
    """Images to splits and clusters by the command line alone."""
    from brightseam import cli

    out, root = str(tmp_path), tmp_path / "train"
    names = [(f"train/{i % 3}_{n}/{n[0]}_{i}.png", str(i % 3), n) for i in range(18) for n in [("Recyclable", "Electronic", "Organic")[i % 3]]]
    pictures = [scene(i) for i in range(18)]
    pictures[5] = pictures[2].copy()  # an exact copy, and a near one
    pictures[3] = pictures[0].copy()
    pictures[3][0, 0] ^= 1
    for (path, _, _), x in zip(names, pictures):
        (tmp_path / path).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / path).write_bytes(png(x))
    (tmp_path / names[17][0]).write_bytes(b"junk")
    rows = [(str(i), p, k, n, "2" if i == 4 else "0", "look again" if i == 4 else "", "") for i, (p, k, n) in enumerate(names)]
    batch = spark.createDataFrame(rows, "image_id string, path string, current_label string, class_name string, review_status string, reason string, encode string")
    for i, part in enumerate((batch.where("cast(image_id as int) < 10"), batch.where("cast(image_id as int) >= 10"))):
        sinks.write_table(part.orderBy(F.col("image_id").cast("int")), f"{out}/b{i}", "review_batch", one_file=True)
    sinks.write_table(spark.createDataFrame([(names[16][0], "1", "blurred", "exclude"), (names[15][0], "", "", "keep")], "path string, review_status string, reason string, decision string"), f"{out}/o", "overrides")
    read = lambda where, name: sorted(files.read_manifest(spark, f"{out}/{where}", name, order=True).collect(), key=lambda r: r["_ord"])
    start = ["make-manifests", "--batch", f"{out}/b0", "--batch", f"{out}/b1", "--images", str(root), "--overrides", f"{out}/o", "--out", f"{out}/m"]
    with pytest.raises(ContractError, match="expected 11 rows, found 10"):
        cli.main([*start, "--expected", "11", "--expected", "8"])
    cli.main([*start, "--expected", "10", "--expected", "8"])
    keep = [r["path"] for r in read("m/keep_manifest", "manifest")]
    assert keep == [p for i, (p, _, _) in enumerate(names) if i != 16] and [r["path"] for r in read("m/remove_manifest", "manifest")] == [names[16][0]]
    assert len(read("m/review_decisions_merged", "review_batch")) == 18 and len(read("m/exact_duplicate_decisions", "exact_duplicate_decisions")) == 2
    cli.main(["audit", "--manifest", f"{out}/m/keep_manifest", "--images", str(root), "--out", f"{out}/a"])
    told = json.loads((tmp_path / "a/audit_summary.json").read_text())
    assert (told["total"], told["corrupt"], told["exact_groups"], told["most_common_sizes"]) == (17, 1, 1, [{"width": 96, "height": 96, "count": 16}]) and told["class_counts"] == {"0": 6, "1": 5, "2": 6}
    cli.main(["signatures", "--images", str(root), "--out", f"{out}/a"])
    cli.main(["near-duplicates", "--audit", f"{out}/a/image_audit", "--signatures", f"{out}/a/signatures", "--out", f"{out}/a"])
    near = read("a/near_duplicate_pairs", "near_duplicate_pairs")
    assert (names[0][0], names[3][0]) in [(r["path_a"], r["path_b"]) for r in near]
    assert json.loads((tmp_path / "a/near_duplicate_summary.json").read_text())["images_hashed"] == 16
    pair = ["--exact", f"{out}/a/exact_duplicates", "--near", f"{out}/a/near_duplicate_pairs"]
    cli.main(["prepare-review", *pair, "--images", str(root), "--out", f"{out}/r"])
    queue = read("r/duplicate_review", "duplicate_review")
    assert queue[0]["folder"] == "duplicate_review/exact/exact_0001" and len(queue) == 1 + len(near)
    assert (tmp_path / "r/review_images/exact/exact_0001/a__label_same__O_2.png").exists()
    done = [(r["folder"], "a" if "exact" in r["folder"] else " both ", r["guide"], r["notes"]) for r in queue]
    sinks.write_table(spark.createDataFrame(done, "folder string, decision string, guide string, notes string"), f"{out}/done", "duplicate_review", one_file=True)
    cli.main(["apply-review", "--manifest", f"{out}/m/keep_manifest", *pair, "--decisions", f"{out}/done", "--out", f"{out}/c"])
    clean = [r["path"] for r in read("c/manifest_clean", "manifest")]
    assert clean == [p for p in keep if p != names[5][0]] and len(read("c/manifest_kept", "manifest")) == 17
    assert [r["reason"] for r in read("c/dedup_remove_manifest", "dedup_remove_manifest")] == ["removed_by_duplicate_review"]
    assert f"- Review rows: `{len(queue)}`" in (tmp_path / "c/duplicate_review_summary.md").read_text()
    cli.main(["split", "--manifest", f"{out}/c/manifest_clean", "--exact-duplicates", f"{out}/a/exact_duplicates", "--group-pairs", f"{out}/c/dedup_group_pairs", "--near-pairs", f"{out}/a/near_duplicate_pairs", "--images", str(root), "--val-fraction", "0.4", "--out", f"{out}/s"])
    told = json.loads((tmp_path / "s/split_summary.json").read_text())
    assert told["row_counts"]["total"] == 16 and told["constraint_counts"]["dedup_group_pairs_retained"] == len(near) and len(told["source_manifest_sha256"]) == 64
    train, val = ([r["path"] for r in read(f"s/{x}_manifest", "manifest")] for x in ("train", "val"))
    assert sorted(train + val) == sorted(clean) and train == [p for p in clean if p in train]
    for x in ("train", "val"):
        args = ["extract-embeddings", "--manifest", f"{out}/s/{x}_manifest", "--images", str(root), "--split", x, "--input-size", "32", "--out", f"{out}/e"]
        cli.main(args)
        cli.main(args)  # those in place belong to the manifest
    rows = read("e/train_embedding_manifest", "embedding_manifest") + read("e/val_embedding_manifest", "embedding_manifest")
    assert [r["path"] for r in rows if r["valid_embedding"] == "0"] == [names[17][0]] and rows[0]["embedding_row"] == "0"
    with pytest.raises(ContractError, match="stale"):
        cli.main(["extract-embeddings", "--manifest", f"{out}/s/val_manifest", "--images", str(root), "--split", "train", "--out", f"{out}/e"])
    cli.main(["cluster-diagnostics", "--train", f"{out}/e/train_embeddings", "--val", f"{out}/e/val_embeddings", "--train-manifest", f"{out}/s/train_manifest", "--train-embedding-manifest", f"{out}/e/train_embedding_manifest", "--images", str(root), "--candidate-k", "2,3", "--final-n-init", "2", "--tiny-cluster-threshold", "1", "--out", f"{out}/k"])
    told = json.loads((tmp_path / "k/cluster_config.json").read_text())
    assert told["k"] in (2, 3) and told["source_train_manifest_fingerprint"][:8] in told["cluster_system_version"] and told["selected_k_rationale"]
    assert np.load(tmp_path / "k/centroids.npy").shape == (told["k"], 192)
    assert all(len(r["inertia_mean"].split(".")[1]) == 6 for r in read("k/k_diagnostics", "k_diagnostics"))
    assert [r["path"] for r in read("k/train_cluster_assignments", "cluster_assignments")] == [p for p in train if p != names[17][0]]
