"""Small tables with the dirt of the real ones."""

from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq

S, L, D, T = pa.string(), pa.int64(), pa.float64(), pa.timestamp("us")
#: Columns of each table; the extra ones carry names that operators use themselves.
SCHEMAS = {
    "image_audit": dict(path=S, current_label=S, class_name=S, width=S, height=S, aspect_ratio=S, sha256=S, error=S, capture_source=S, audited_at=T, id=L, image=S),
    "manifest_clean": dict(image_id=S, path=S, current_label=S, class_name=S, review_status=S, reason=S, id=L, label=S, u=D, root=L, split=S),
    "exact_duplicates": dict(sha256=S, count=S, paths=S, u=L, p=S, v=L),
    "near_duplicate_pairs": dict(path_a=S, label_a=S, class_a=S, path_b=S, label_b=S, class_b=S, phash_distance=S, dhash_distance=S, whash_distance=S, matching_hashes=S, cross_label=S, u=L, v=L, x=L, y=L),
    "dedup_group_pairs": dict(source_folder=S, path_a=S, path_b=S, reason=S, u=L, v=L),
    "duplicate_review_actions": dict(folder=S, type=S, decision=S, keep_path=S, remove_path=S, group_paths=S, id=L, root=L),
    "embedding_manifest": dict(embedding_row=S, path=S, source_manifest=S, valid_embedding=S, embedding_error=S, row=L, image=L),
    "cluster_assignments": dict(path=S, label=S, cluster_id=S, distance_to_centroid=S, cluster_system_version=S, name=S, image=L),
    "documents": dict(doc_id=L, text=S, lang=S, source=S, n_chars=L, author=S, image_path=S, created_at=T, ids=S, score=D, n_tokens=L, item=L),
    "moderation_labels": dict(doc_id=L, rater=S, category=S, text=S),
    "image_vectors": dict(embedding_row=L, embedding=pa.list_(pa.float32()), vec=S, row=L),
    "sample_targets": dict(request_id=L, label=S, target_share=D, sample_size=L, min_rows=L, n=L, taken=L),
    "container_sizes": dict(run_name=S, tokenizer=S, capacity_tokens=L),
}


def write(folder, name, rows):
    s = pa.schema(list(SCHEMAS[name].items()))
    pq.write_table(pa.Table.from_pylist([{c: r.get(c) for c in SCHEMAS[name]} for r in rows], schema=s), f"{folder}/{name}.parquet")


def empty(folder):
    for name in SCHEMAS:
        write(folder, name, [])
    return folder


def nulls(folder):
    for name in SCHEMAS:
        write(folder, name, [{}, {}])
    return folder


def spell(rng, p):
    return rng.choice([p, p, p, "./" + p, p.replace("/", "\\"), p.replace("_", "%5F", 1), f"/mnt/x/{p}", p.upper(), f" {p}\n"])


def build(folder, n=90, seed=3):
    rng = random.Random(seed)
    paths = []
    for i in range(n):
        c, s, o = rng.choice("REO"), rng.choice(["bk07", "aa11"]), rng.randint(1, n // 3)
        paths.append(f"train/{'REO'.index(c)}_{['Recyclable', 'Electronic', 'Organic']['REO'.index(c)]}/" + rng.choice([f"{c}_{s}_{o:06d}_{i}.jpg", f"{c}.{s.title()}.{o}.{i:03d}.png", f"{c}_{s}{o:06d}s{i}.jpeg", f"thumb_{c}_{s}-{o:05d}-v{i}.jpg"]))
    digests = [f"{rng.getrandbits(256):064x}" for _ in range(n // 3)]
    label = lambda: rng.choice(["0", "1", "2", " 0", "2.0", "Organic", "", None, "9"])
    stamp = lambda: dt.datetime(2026, 1, 1) + dt.timedelta(microseconds=rng.randint(0, 10**12))
    audit = []
    for p in paths:
        for _ in range(rng.choice([1, 1, 2, 3])):
            d = rng.choice(digests)
            audit.append(dict(path=p, current_label=label(), width=rng.choice(["640", "480px", "1,024", "?", None, "-3"]), height=rng.choice(["640", "480.0", ""]), sha256=rng.choice([d, d, d.upper(), "sha256:" + d, d[:-1], None]), error=rng.choice(["", None, " ", "broken"]), capture_source=rng.choice(["bk07", "BK-07", "n/a", None]), audited_at=stamp()))
    write(folder, "image_audit", audit + audit[:4])
    bad = [None, "", "train/1_Electronic/E_zq01_000001_x.jpg"]
    any_path = lambda: spell(rng, rng.choice(paths)) if rng.random() < 0.93 else rng.choice(bad)
    man = [dict(image_id=str(i), path=spell(rng, p), current_label=label(), review_status="0") for i, p in enumerate(paths) if rng.random() < 0.8]
    write(folder, "manifest_clean", man + man[:5] + [{}])
    for t, k in (("near_duplicate_pairs", n // 3), ("dedup_group_pairs", n // 6)):
        rows = [dict(path_a=any_path(), path_b=any_path(), cross_label="False") for _ in range(k)]
        write(folder, t, rows + rows[:3] + [dict(path_a=rows[0]["path_b"], path_b=rows[0]["path_a"]), {}])
    write(folder, "exact_duplicates", [dict(sha256=rng.choice(digests), count="2", paths="|".join(str(any_path() or "") for _ in range(rng.randint(1, 4)))) for _ in range(n // 8)] + [{}])
    acts = [dict(folder=f"f{i}", type="near_same", decision="a", keep_path=any_path(), remove_path=any_path()) for i in range(n // 3)]
    write(folder, "duplicate_review_actions", acts + acts[:3] + [{}])
    emb, vec, clu = [], [], []
    g = np.random.default_rng(seed)
    centres = np.linalg.qr(g.normal(size=(64, 64)))[0][:3]
    near = {}
    for i, p in enumerate(paths, 1):
        c = i % 3
        ok = rng.choice(["1", "1", "1", "True", " 1", "0", ""])
        emb.append(dict(embedding_row=rng.choice([str(i), f"{i}.0", f" {i}"]), path=spell(rng, p), source_manifest=rng.choice(["o/train_manifest.csv", "o/train_manifest.csv", "o\\VAL_manifest.csv", "o/test_manifest.csv.gz"]), valid_embedding=ok))
        base = near.setdefault((c, i // 9), centres[c] * 0.8 + g.normal(size=64) * 0.07)
        v = (base + g.normal(size=64) * 0.008) * rng.choice([0.1, 1, 20])
        vec.append(dict(embedding_row=i, embedding=[float(x) for x in v] if rng.random() < 0.93 else rng.choice([None, [], [1.0] * 63, [0.0] * 64, [float("nan")] * 64])))
        clu.append(dict(path=spell(rng, p), label="0", cluster_id=rng.choice([f"C{c + 4:02d}", f"cluster {c + 4}", f"C{c + 4}"]) if rng.random() < 0.9 else rng.choice(["?", None, "C99"]), cluster_system_version="rn_k3_20260402_aa"))
    write(folder, "embedding_manifest", emb + emb[:4] + [{}])
    write(folder, "image_vectors", vec + vec[:4] + [{}])
    write(folder, "cluster_assignments", clu + [dict(path=r["path"], cluster_id="C01", cluster_system_version="rn_k3_20250101_bb") for r in clu] + [{}])
    ok = ["The lamp is too dark today.", "Please move the box to bay four.", "Foto botol ini buram sekali.", "The second copy is smaller."]
    ill = ["You are a stupid idiot and a liar.", "Shut up, you stupid clown.", "Du bist ein Idiot."]
    docs, labels = [], []
    for i in range(1, 161):
        harmful = i % 4 == 0
        text = " ".join([rng.choice(ok), rng.choice(ok)] + ([rng.choice(ill)] if harmful else []) + [rng.choice(ok)])
        docs.append(dict(doc_id=i, text=text, source=rng.choice(["log", " LOG", None, ""])))
        if i <= 120:
            labels.append(dict(doc_id=i, rater="m", category=("abuse" if harmful else rng.choice(["ok", "OK "]))))
    docs += [dict(doc_id=200, text=None), dict(doc_id=201, text=""), dict(doc_id=202, text="  \n"), dict(doc_id=203, text="x" * 30_000), dict(doc_id=204, text="漢字かな交じり文 👍🏽 naïve​\x00 it's 12345 we'll"), dict(doc_id=205, text="a b " * 4_000), dict(doc_id=206, text="You are a st​up1d i.d.i.o.t and a liar.")]
    write(folder, "documents", docs)
    write(folder, "moderation_labels", labels + labels[:3] + [{}, dict(doc_id=5, category="?")])
    write(folder, "sample_targets", [dict(request_id=1, label=k, target_share=s, sample_size=20, min_rows=2) for k, s in zip("012", (0.5, 0.25, 0.25))] + [dict(request_id=2, label=k, target_share=s, sample_size=1000, min_rows=0) for k, s in zip("012", (0.1, 0.1, 0.8))])
    write(folder, "container_sizes", [dict(run_name="small", tokenizer="byte_bpe_50k", capacity_tokens=40), dict(run_name="large", tokenizer="byte_bpe_50k", capacity_tokens=4096)])
    return folder
