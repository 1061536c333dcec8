"""DuckDB's SQL for the registered queries."""

from __future__ import annotations

_WS = r"[\s\x{00a0}\x{0085}\x{200b}-\x{200d}\x{2060}\x{feff}\p{Z}]"


def strip(c: str) -> str:
    return f"regexp_replace({c}, '^{_WS}+|{_WS}+$', '', 'g')"


def label(c: str) -> str:
    """The class that a label denotes by number or name; NULL if none."""
    v = f"lower({strip(c)})"
    cases = " ".join(f"when regexp_matches({v}, '^(?:\\+?0*{k}(?:\\.0*)?|(?:0*{k}[ _-])?{n})$') then '{k}'" for k, n in (("0", "recyclable"), ("1", "electronic"), ("2", "organic")))
    return f"case {cases} end"


MANI = (
    "mani as materialized (select cast(s.id as varchar) image_id, path, s.current_label current_label, s.class_name class_name, coalesce(" + label("s.current_label") + ", 'unreadable') as lab from "
    "(select path, min(row(cast(image_id as bigint), current_label, class_name, review_status, reason)::struct(id bigint, current_label varchar, class_name varchar, review_status varchar, reason varchar)) s from manifest_clean where path is not null group by path))"
)
PLUS = "plus as materialized (select vec_id, embedding::double[] e, label from embeddings union all select vec_id + 1000000, list_append(embedding[1:63]::double[], -embedding[64]::double), label from embeddings where vec_id % 10 = 0)"
SIG = (
    PLUS
    + ", bitted as materialized (select vec_id, label, list_transform(e, lambda x: case when x > list_aggregate(e, 'median') then 1 else 0 end) p, "
    "list_transform(range(1, 65), lambda i: case when i < 64 and e[i + 1] > e[i] then 1 else 0 end) d, list_transform(e, lambda x: case when x > 0 then 1 else 0 end) w from plus), "
    "sig as materialized (select vec_id, label, " + ", ".join(f"array_to_string(list_transform(range(16), lambda i: substr('0123456789abcdef', (1 + 8 * {b}[4 * i + 1] + 4 * {b}[4 * i + 2] + 2 * {b}[4 * i + 3] + {b}[4 * i + 4])::bigint, 1)), '') {n}" for b, n in (("p", "phash"), ("d", "dhash"), ("w", "whash"))) + " from bitted)"
)


def ham(a: str, b: str) -> str:
    return f"bit_count(xor(('0x' || {a})::ubigint, ('0x' || {b})::ubigint))"


NEAR = (
    SIG
    + ", dist as materialized (select a.vec_id va, b.vec_id vb, cast(a.vec_id as varchar) path_a, cast(a.label % 3 as varchar) label_a, cast(b.vec_id as varchar) path_b, cast(b.label % 3 as varchar) label_b, "
    + ", ".join(f"cast({ham('a.' + h, 'b.' + h)} as integer) {h}_distance" for h in ("phash", "dhash", "whash"))
    + " from sig a join sig b on a.phash[1:4] = b.phash[1:4] and a.vec_id < b.vec_id), "
    "near as (select path_a, label_a, path_b, label_b, phash_distance, dhash_distance, whash_distance, cast((phash_distance <= 4)::int + (dhash_distance <= 4)::int + (whash_distance <= 4)::int as integer) matching_hashes, case when label_a <> label_b then 'True' else 'False' end cross_label from dist "
    "where (phash_distance <= 4)::int + (dhash_distance <= 4)::int + (whash_distance <= 4)::int >= 2)"
)
LIST = "list_filter(string_split(paths, '|'), lambda x: x <> '')"
IN_ORDER = "(select *, row_number() over () place from {0})"
FOLDERS = (
    f"folders as materialized (select 'duplicate_review/exact/exact_' || printf('%04d', place) folder, 'exact' as \"type\", string_split(paths, '|')[1] path_a, string_split(paths, '|')[2] path_b, cast(len(string_split(paths, '|')) as integer) members from {IN_ORDER.format('exact_duplicates')} union all "
    f"select 'duplicate_review/' || k || '/' || k || '_' || printf('%04d', row_number() over (partition by k order by place)), k, path_a, path_b, 2 from (select *, case when cross_label = 'True' then 'near_cross' else 'near_same' end k from {IN_ORDER.format('near_duplicate_pairs')}))"
)
DECISIONS = FOLDERS + ", decisions as (select folder, case n % 4 when 0 then 'a' when 1 then 'b' when 2 then 'both' else 'ignore' end decision from (select folder, cast(regexp_extract(folder, '(\\d+)$', 1) as bigint) n from folders) where n % 17 <> 0)"
ACTIONS = DECISIONS + (
    ", actions as materialized (select folder, \"type\", decision, case decision when 'a' then path_a when 'b' then path_b else '' end keep_path, case decision when 'a' then path_b when 'b' then path_a else '' end remove_path, "
    "case when decision = 'both' then concat_ws('|', path_a, path_b) else '' end group_paths from decisions join folders using (folder))"
)
REMOVALS = f"removals as (select remove_path path, arg_max(folder, place) folder, arg_max(decision, place) decision from {IN_ORDER.format('duplicate_review_actions')} where coalesce(remove_path, '') <> '' group by 1)"
OVERRIDDEN = REMOVALS + ", ov as (select image_id, m.path, current_label, class_name, case when r.path is not null then '1' else review_status end review_status, case when r.path is not null then 'see ' || r.folder else reason end reason from manifest_clean m left join removals r on r.path = m.path)"
CELLS = f"cells as (select g, unnest(range(len(l))) pos, unnest(l) path from (select paths g, {LIST} l from (select distinct paths from exact_duplicates where paths is not null))), held as (select * from cells where path in (select path from mani))"
EDGES = (
    MANI + ", " + CELLS + ", edges as materialized (select distinct * from (select arg_min_path as \"left\", path as \"right\", 'exact_duplicate' source from held join (select g, arg_min(path, pos) arg_min_path from held group by g) using (g) where path <> arg_min_path union all "
    "select path_a, path_b, 'dedup_group_pair' from dedup_group_pairs where path_a in (select path from mani) and path_b in (select path from mani)))"
)
COMP = (
    EDGES + ", ways as materialized (select \"left\" a, \"right\" b from edges union select \"right\", \"left\" from edges), reach(a, b) as (select a, b from ways union select a, a from ways union select r.a, w.b from reach r join ways w on r.b = w.a), "
    "comp as materialized (select a node, min(b) root from reach group by a)"
)
GROUPS = (
    COMP + ", members as materialized (select m.path, m.lab as \"label\", coalesce(root, m.path) root from mani m left join comp on node = m.path), src as (select root, string_agg(source, '|' order by source) sources from (select distinct root, source from edges join comp on node = \"left\") group by root), "
    "groups as materialized (select root, count(*) group_size, count(*) filter (\"label\" = '0') n0, count(*) filter (\"label\" = '1') n1, count(*) filter (\"label\" = '2') n2, count(*) filter (\"label\" = 'unreadable') nunreadable from members group by root), "
    "g as materialized (select groups.*, coalesce(sources, 'singleton') sources, 'G' || printf('%05d', row_number() over (order by root)) group_id from groups left join src using (root))"
)
MIXED = "((n0 > 0)::int + (n1 > 0)::int + (n2 > 0)::int > 1)"
MIXED4 = "((n0 > 0)::int + (n1 > 0)::int + (n2 > 0)::int + (nunreadable > 0)::int > 1)"


def draw(seed: str) -> str:
    return f"('0x' || substr(sha256('{seed}:' || group_id), 1, 13))::bigint / 4503599627370496.0"


def fit(label: str, target: str) -> str:
    """CTEs fit_<label>: the groups first fit takes, then the one that lowers the gap."""
    n = label
    return (
        f", pool_{n} as materialized (select group_id, group_size, {draw('63:' + n)} draw from g where not {MIXED4} and n{n} > 0), goal_{n} as (select greatest(0, {target}) goal), "
        f"walk_{n} as materialized (select list_reduce(list_prepend({{'s': (select goal from goal_{n})::bigint, 'c': []::varchar[], 'z': 0::bigint}}, coalesce(list({{'s': 0::bigint, 'c': [group_id]::varchar[], 'z': group_size::bigint}} order by draw, group_id), [])), "
        f"lambda a, x: case when x.z <= a.s then {{'s': a.s - x.z, 'c': list_concat(a.c, x.c), 'z': 0::bigint}} else a end) w from pool_{n}), "
        f"took_{n} as materialized (select unnest(w.c) group_id from walk_{n}), "
        f"fit_{n} as materialized (select group_id from took_{n} union all select * from (select group_id from pool_{n}, walk_{n} where group_id not in (select group_id from took_{n}) and abs(group_size - w.s) < w.s order by abs(group_size - w.s), group_id limit 1))"
    )


TARGETS = "targets as materialized (select lab as \"label\", count(*) n, cast(round_even(count(*) * 0.2, 0) as bigint) target from mani group by 1)"
SPLITS = (
    GROUPS + ", " + TARGETS + f", mixed_val as materialized (select * from g where {MIXED4} and {draw('63')} < 0.2)"
    + "".join(fit(k, f"(select coalesce(max(target), 0) from targets where \"label\" = '{k}') - (select coalesce(sum(n{k}), 0) from mixed_val)") for k in ("0", "1", "2", "unreadable"))
    + ", picked as (select group_id from mixed_val union select group_id from fit_0 union select group_id from fit_1 union select group_id from fit_2 union select group_id from fit_unreadable), "
    "splits as materialized (select group_id, root, case when group_id in (select group_id from picked) then 'val' else 'train' end split from g)"
)
CENT = "cent as materialized (select row_number() over (order by vec_id) - 1 c, embedding::double[] m from (select * from embeddings order by vec_id limit 8))"
ASSIGNED = (
    CENT + ", assigned as materialized (select cast(vec_id as varchar) path, cast(\"label\" % 3 as varchar) as \"label\", c cluster, dist, case when vec_id % 5 = 0 then 'val' else 'train' end split, place from "
    "(select vec_id, \"label\", c, place, list_distance(embedding::double[], m) dist from (select *, row_number() over () place from embeddings), cent) qualify row_number() over (partition by vec_id order by dist, c) = 1), "
    "asg as materialized (select path, \"label\", 'C' || printf('%02d', cluster) cluster_id, printf('%.6f', dist) distance_to_centroid, split, place from assigned), "
    "spine as (select 'C' || printf('%02d', i) cluster_id from range(9) r(i))"
)
STRIPPED = "rv as (select regexp_replace(path, '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g') path, regexp_replace(review_status, '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g') status, reason from manifest_clean), nm as (select path, count(*) n from rv where coalesce(path, '') <> '' group by 1)"


def share(first: str, second: str, out: str) -> str:
    return f"select {first}, {second}, count(*) as \"count\", printf('%.6f', count(*) / sum(count(*)) over (partition by {first})) {out} from cluster_assignments where \"label\" is not null and cluster_id is not null group by 1, 2"


def oracle_sql() -> dict[str, str]:
    raw = "regexp_replace(coalesce(review_status, 'x'), '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g')"
    cols = "image_id, path, current_label, class_name, review_status, reason"
    out = {
        "exact_duplicate_groups": "select sha256(text) sha256, count(*) as \"count\", string_agg(cast(doc_id as varchar), '|' order by doc_id) paths from documents where text is not null group by 1 having count(*) > 1",
        "exact_duplicate_rows": "select h sha256, count(*) over (partition by h) as \"count\", cast(row_number() over (partition by h order by doc_id) - 1 as integer) pos, cast(doc_id as varchar) path from (select sha256(text) h, doc_id from documents where text is not null) where h in (select sha256(text) from documents where text is not null group by 1 having count(*) > 1)",
        "review_copies": f"select path, 'exact/exact_' || printf('%04d', place) || '/' || chr((97 + i)::integer) || '__label_same__' || list_last(string_split(path, '/')) as \"name\" from (select place, unnest(string_split(paths, '|')) path, unnest(range(len(string_split(paths, '|')))) i from {IN_ORDER.format('exact_duplicates')} where paths is not null) union all "
        f"select path, kk || '/' || kk || '_' || printf('%04d', n) || '/' || side || '__label_' || lab || '__' || list_last(string_split(path, '/')) from (select kk, n, unnest(['a', 'b']) side, unnest([path_a, path_b]) path, unnest([label_a, label_b]) lab from (select *, row_number() over (partition by kk order by place) n from (select *, case when cross_label = 'True' then 'near_cross' else 'near_same' end kk from {IN_ORDER.format('near_duplicate_pairs')})))",
        "kmeans_check": "select count(*) as \"rows\", 8::bigint clusters, true same_cost from embeddings",
        "k_diagnostics_check": "select k, (select least(count(*), 5000) from embeddings) sample, 3 n_stability_runs, true sizes_fit, true scores_fit from (values (12), (16), (20), (24), (32)) v(k)",
        "select_k_rule": "with d(request, k, tiny, sil, ari) as (values ('gate', 12, 0, 0.20, 0.80), ('gate', 16, 0, 0.30, 0.70), ('gate', 20, 0, 0.25, 0.90), ('gate', 24, 2, 0.90, 0.99), ('none', 12, 3, 0.10, 0.20), ('none', 16, 1, -1, 0.30), ('none', 20, 1, -0.50, 0.10), ('none', 24, 1, -0.50, 0.40), ('tie', 12, 0, 0.50, 0.90), ('tie', 16, 0, 0.50, 0.90)), "
        "e as (select *, tiny = 0 and ari >= 0.75 stable from d) select request, k, stable from e qualify row_number() over (partition by request order by stable desc, tiny, sil desc, ari desc, k) = 1",
        "exact_duplicate_members": f"select sha256, cast(pos as integer) pos, path from (select sha256, unnest(range(len(l))) pos, unnest(l) path from (select sha256, {LIST} l from exact_duplicates where paths is not null)) where path in (select path from image_audit)",
        "audit_summary": "with ok as (select *, coalesce(error, '') = '' fine from image_audit), gr as (select count(*) n from ok where fine and coalesce(sha256, '') <> '' group by sha256 having count(*) > 1) select (select count(*) from ok) total, (select count(*) from ok where not fine) corrupt, (select count(*) from (select distinct width, height from ok where fine)) distinct_sizes, (select count(*) from gr) exact_groups, cast((select coalesce(sum(n), 0) from gr) as bigint) exact_rows",
        "audit_rows_with_error": "select cast(doc_id as varchar) path, case when e = '' then coalesce(cast(n_chars as varchar), '') else '' end width, case when e = '' then coalesce(cast(length(source) as varchar), '') else '' end height, case when e = '' and length(source) > 0 then printf('%.6f', round_even(n_chars / length(source), 6)) else '' end aspect_ratio, case when e = '' then coalesce(sha256(text), '') else '' end sha256, e error from (select *, case when coalesce(n_chars, 0) < 20 then 'too short' else '' end e from documents)",
        "class_counts": "select coalesce(current_label, '') as \"label\", count(*) n from manifest_clean group by 1",
        "most_common_sizes_top10": f"select width, height, n from (select width, height, count(*) n, min(place) p from {IN_ORDER.format('image_audit')} where coalesce(error, '') = '' group by 1, 2 order by n desc, p limit 10)",
        "manifest_projection": "select image_id, list_last(string_split(path, '/')) file, current_label as \"label\", 'manifest' origin from manifest_clean",
        "status_keep": f"with {OVERRIDDEN} select {cols} from ov where {raw} in ('0', '2')",
        "status_remove": f"with {OVERRIDDEN} select {cols} from ov where {raw} = '1'",
        "status_unsure": f"with {OVERRIDDEN} select {cols} from ov where {raw} = '2'",
        "review_union_with_expected_counts": "select file, expected, found from (select file, expected, (select count(*) from manifest_clean where 'batch_' || (cast(image_id as bigint) % 3) = file) found from (values ('batch_0', 1000::bigint), ('batch_1', 1000::bigint), ('batch_3', 5::bigint)) v(file, expected)) where expected <> found",
        "review_errors_by_rule": f"with {STRIPPED}, f as (select distinct path from image_audit), e as (select 'blank_path' rule, '' path, count(*) n from rv where coalesce(path, '') = '' having count(*) > 0 union all select 'bad_status', coalesce(path, ''), count(*) from rv where coalesce(status not in ('0', '1', '2'), true) group by 2 union all select 'duplicate_path', path, n from nm where n > 1 union all select 'unknown_path', path, 1 from nm where path not in (select path from f) union all select 'unreviewed_path', path, 1 from f where path not in (select path from nm) union all select 'missing_reason', coalesce(path, ''), count(*) from rv where status in ('1', '2') and trim(coalesce(reason, '')) = '' group by 2) select rule, count(*) findings, cast(sum(n) as bigint) as \"rows\" from e group by 1",
        "missing_review_paths": f"with {STRIPPED} select distinct path from image_audit where path not in (select path from nm)",
        "extra_review_paths": f"with {STRIPPED} select path from nm where path not in (select path from image_audit)",
        "override_status": f"with {OVERRIDDEN} select review_status, count(*) as \"rows\", count(*) filter (reason like 'see %') overridden from ov group by 1",
        "manifest_contract_violations": "select 'duplicate_path' rule, count(*) n from (select path from manifest_clean group by path having count(*) > 1) union all select 'bad_label', count(*) from manifest_clean where coalesce(current_label not in ('0', '1', '2'), true) union all select 'missing_file', count(*) from manifest_clean where path is null or path not in (select path from image_audit)",
        "existence_anti_join": "select image_id, path from manifest_clean where path is null or path not in (select path from image_audit)",
        "signature_hex": f"with {SIG} select vec_id, phash, dhash, whash from sig",
        "hamming_distance": f"with {SIG} select a.vec_id, cast({ham('a.phash', 'b.phash')} as integer) distance from sig a join sig b on b.vec_id = a.vec_id + 1",
        "near_duplicate_pairs": f"with {NEAR} select * from near",
        "near_duplicate_ranking": f"with {NEAR} select path_a, path_b, cross_label, row_number() over (order by cross_label desc, phash_distance + dhash_distance + whash_distance, path_a, path_b) place from near",
        "near_duplicate_summary": f"with {NEAR} select '' source, (select count(*) from sig) images_hashed, 'phash, dhash and whash; candidates share the first 4 hex digits of phash' as \"method\", 'at least 2 of 3 distances <= 4' threshold, true exact_sha256_duplicates_excluded, (select count(*) from near) near_duplicate_pairs, (select count(*) from near where cross_label = 'True') cross_label_pairs",
        "review_queue": f"with {FOLDERS} select folder, '' decision, 'a=keep A remove B; b=keep B remove A; both=keep both same split; ignore=false positive' guide, \"type\" notes from folders",
        "folder_pair_map": f"with {FOLDERS} select * from folders",
        "duplicate_actions": f"with {ACTIONS} select * from actions",
        "missing_review_folders": f"with {DECISIONS} select folder from folders where folder not in (select folder from decisions)",
        "actions_summary_counts": f"with {ACTIONS} select \"type\", decision, count(*) actions, count(distinct nullif(remove_path, '')) removed_paths, count(*) filter (coalesce(group_paths, '') <> '') as \"grouped\" from actions group by 1, 2",
        "clean_manifest": f"select {cols} from manifest_clean where path is null or path not in (select remove_path from duplicate_review_actions where coalesce(remove_path, '') <> '')",
        "removed_manifest": f"with {REMOVALS} select path, current_label as \"label\", class_name, r.folder source_folder, r.decision decision, 'removed_by_duplicate_review' reason from manifest_clean join removals r using (path)",
        "group_pairs": "select folder source_folder, string_split(group_paths, '|')[1] path_a, string_split(group_paths, '|')[2] path_b, 'duplicate_review_both' reason from duplicate_review_actions where coalesce(group_paths, '') <> ''",
        "retained_edges": f"with {EDGES} select * from edges",
        "edge_accounting": f"with {EDGES}, m as (select path from mani) select 'exact_edges' kind, count(*) n from edges where source = 'exact_duplicate' " + " ".join(f"union all select '{x}_total', count(*) from {x} union all select '{x}_retained', count(*) from {x} where path_a in (select path from m) and path_b in (select path from m)" for x in ("dedup_group_pairs", "near_duplicate_pairs")),
        "unsafe_near_pairs": f"with {MANI} select distinct least(path_a, path_b) lo, greatest(path_a, path_b) hi from near_duplicate_pairs where path_a in (select path from mani) and path_b in (select path from mani) and row(least(path_a, path_b), greatest(path_a, path_b)) not in (select row(least(path_a, path_b), greatest(path_a, path_b)) from dedup_group_pairs where path_a is not null and path_b is not null)",
        "connected_components": f"with recursive {COMP} select node, root from comp",
        "component_groups": f"with recursive {GROUPS} select root, group_size, n0, n1, n2, sources, group_id from g",
        "mixed_label_groups": f"with recursive {GROUPS} select group_id, n0, n1, n2 from g where {MIXED}",
        "val_targets": f"with {MANI}, {TARGETS} select * from targets",
        "split_mixed_bernoulli": f"with recursive {GROUPS} select group_id, round({draw('63')}, 6) draw, {draw('63')} < 0.2 in_val from g where {MIXED4}",
        "split_first_fit": f"with recursive {GROUPS}, {TARGETS}{fit('2', '(select max(target) from targets where label = chr(50))')} select group_id from fit_2",
        "split_assignment": f"with recursive {SPLITS} select group_id, split from splits",
        "train_manifest": f"with recursive {SPLITS} select path, \"label\", group_id from members join splits using (root) where split = 'train'",
        "val_manifest": f"with recursive {SPLITS} select path, \"label\", group_id from members join splits using (root) where split = 'val'",
        "split_summary": f"with recursive {SPLITS} select split, \"label\", count(*) as \"rows\", count(distinct group_id) as \"groups\" from members join splits using (root) group by 1, 2",
        "l2_normalized_vectors": "select vec_id, round(list_sum(list_transform(u, lambda x: x * x)), 6) norm2, round(u[1], 5) as \"first\" from (select vec_id, list_transform(v, lambda x: x / sqrt(list_sum(list_transform(v, lambda y: y * y)))) u from (select vec_id, list_transform(embedding::double[], lambda x: x * 3) v from embeddings))",
        "fixed_sample": "select vec_id from embeddings order by sha256('63:' || cast(vec_id as varchar)), vec_id limit 100",
        "nearest_centroid_assignment": f"with {ASSIGNED} select path, cluster_id, round(cast(distance_to_centroid as double), 4) distance from asg",
        "lloyd_step": "select \"label\", cast(i as integer) i, round(avg(x), 5) mean from (select \"label\", unnest(range(64)) i, unnest(embedding::double[]) x from embeddings) group by 1, 2",
        "silhouette_by_label": "with v as materialized (select vec_id, embedding::double[] e, \"label\" l from embeddings order by sha256('63:' || cast(vec_id as varchar)), vec_id limit 5000), n as (select l, count(*) n from v group by l), d as (select a.vec_id, a.l own, b.l l, sum(list_distance(a.e, b.e)) s from v a, v b group by all), ab as (select d.vec_id, own, max(case when d.l = own then s / greatest(n - 1, 1) end) a, min(case when d.l <> own then s / n end) b, max(case when d.l = own then n end) size from d join n on n.l = d.l group by 1, 2) select round(avg(case when size > 1 then (b - a) / greatest(a, b) else 0 end), 6) silhouette from ab",
        "adjusted_rand_index": f"with {ASSIGNED}, c as (select \"label\" l, cluster k, count(*)::double n from assigned group by 1, 2), s as (select sum(n * (n - 1) / 2) s, sum(n) al from c), a as (select sum(n * (n - 1) / 2) sa from (select sum(n) n from c group by l)), b as (select sum(n * (n - 1) / 2) sb from (select sum(n) n from c group by k)) select round((s - sa * sb / (al * (al - 1) / 2)) / ((sa + sb) / 2 - sa * sb / (al * (al - 1) / 2)), 6) ari from s, a, b",
        "cluster_sizes_relabelled": f"with {ASSIGNED}, z as (select i cluster, (select count(*) from assigned where cluster = i) n from range(8) r(i)) select cast(cluster as integer) cluster, cast(row_number() over (order by n desc, cluster) - 1 as integer) as \"new\", n from z",
        "label_composition": share("cluster_id", "\"label\"", "proportion_within_cluster"),
        "label_cluster_distribution": share("\"label\"", "cluster_id", "proportion_within_label"),
        "cluster_summary": f"with {ASSIGNED}, tr as (select * from asg where split = 'train'), n as (select cluster_id, \"label\", count(*) n from tr group by 1, 2), tot as (select cluster_id, cast(sum(n) as bigint) t, arg_min(\"label\", row(-n, \"label\")) top, max(n) mx from n group by 1), ent as (select cluster_id, -sum(n / t * ln(n / t)) h from n join tot using (cluster_id) group by 1), ds as (select cluster_id, median(cast(distance_to_centroid as double)) md, quantile_cont(cast(distance_to_centroid as double), 0.95) p from tr group by 1), v as (select cluster_id, count(*) v from asg where split = 'val' group by 1) "
        "select cluster_id, coalesce(t, 0) train_count, coalesce(v, 0) val_count, coalesce(top, '') dominant_train_label, coalesce(printf('%.6f', mx / t), '') dominant_train_label_proportion, printf('%.6f', coalesce(abs(h), 0)) label_entropy, coalesce(printf('%.6f', round_even(md, 6)), '') assigned_centroid_distance_median, coalesce(printf('%.6f', round_even(p, 6)), '') assigned_centroid_distance_p95 from spine left join tot using (cluster_id) left join ent using (cluster_id) left join ds using (cluster_id) left join v using (cluster_id)",
        "cluster_representatives": f"with {ASSIGNED}, r as (select *, row_number() over (partition by split, cluster_id order by cast(distance_to_centroid as double), place) a, row_number() over (partition by split, cluster_id order by cast(distance_to_centroid as double) desc, place desc) b from asg) select cluster_id, split, path, \"label\", cast(a as integer) as \"rank\", 'nearest' representative_type from r where a <= 3 union all select cluster_id, split, path, \"label\", cast(b as integer), 'farthest' from r where b <= 3",
        "validation_coverage": f"with {ASSIGNED}, x as (select cluster_id, (select count(*) from asg a where a.cluster_id = s.cluster_id and split = 'train') t, (select count(*) from asg a where a.cluster_id = s.cluster_id and split = 'val') v from spine s), y as (select *, t / (select count(*) from asg where split = 'train') ts, v / (select count(*) from asg where split = 'val') vs from x) select cluster_id, t train_count, printf('%.6f', ts) train_proportion, v val_count, printf('%.6f', vs) val_proportion, case when v = 0 then 'missing_in_val' when vs < 0.5 * ts then 'underrepresented_in_val' when ts > 0 and vs > 2 * ts then 'overrepresented_in_val' else 'ok' end coverage_note from y",
        "valid_embedding_rows": "with e as (select try_cast(nullif(regexp_extract(regexp_replace(embedding_row, '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g'), '^\\+?(\\d{1,18})(?:\\.0*)?$', 1), '') as bigint) n, coalesce(valid_embedding, '') = '1' ok from embedding_manifest), u as (select n, bool_or(ok) ok from e where n is not null group by n) select n, case when ok then row_number() over (partition by ok order by n) - 1 else -1 end row_no from u",
        "cache_staleness": "select 'cached' state, count(*) n from (select distinct path from manifest_clean where path is not null) where path in (select path from embedding_manifest) union all select 'missing', count(*) from (select distinct path from manifest_clean where path is not null) where path not in (select path from embedding_manifest where path is not null) union all select 'stale', count(*) from (select distinct path from embedding_manifest where path is not null) where path not in (select path from manifest_clean where path is not null)",
        "macro_f1": f"with {ASSIGNED}, x as (select \"label\" truth, cast(cluster % 3 as varchar) guess from assigned), f as (select k, (select 2.0::double * count(*) from x where truth = k and guess = k) / ((select count(*) from x where truth = k) + (select count(*) from x where guess = k)) f from (values ('0'), ('1'), ('2')) v(k)) select round(sum(f) / 3, 6) macro_f1 from f",
        "ordered_submission": "with w as (select regexp_replace(path, '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g') path, min(cast(image_id as bigint)) id from manifest_clean where path is not null group by 1), p as (select path, min(cluster_id) prediction from cluster_assignments where path is not null group by 1) select w.path, id, prediction from w left join p on p.path = w.path",
    }
    return out
