"""The queries in DuckDB's SQL, where SQL can state them on whole tables."""

from __future__ import annotations

_WS = r"[\s\x{00a0}\x{0085}\x{200b}-\x{200d}\x{2060}\x{feff}\p{Z}]"


def strip(c: str) -> str:
    return f"regexp_replace({c}, '^{_WS}+|{_WS}+$', '', 'g')"


def key(c: str) -> str:
    p = strip(f"lower(url_decode({c}))")
    p = f"regexp_replace({p}, '[\\\\/]+(?:\\.[\\\\/]+)*', '/', 'g')"
    p = f"regexp_replace({p}, '^\\./', '')"
    return f"nullif(regexp_replace({p}, '^(?s:.*)/([^/]+/[^/]+/[^/]+)$', '\\1'), '')"


def label(c: str) -> str:
    t = f"lower({strip(c)})"
    cases = " ".join(f"when regexp_matches({t}, '^(?:\\+?0*{k}(?:\\.0*)?|(?:0*{k}[ _-])?{n})$') then '{k}'" for k, n in (("0", "recyclable"), ("1", "electronic"), ("2", "organic")))
    return f"case {cases} end"


def digest(c: str) -> str:
    return f"nullif(regexp_extract(lower({strip(c)}), '^(?:sha-?256\\s*[:=-]?\\s*)?([0-9a-f]{{64}})$', 1), '')"


def blank(c: str) -> str:
    return f"coalesce({strip(c)}, '') = ''"


def number(c: str) -> str:
    t = f"regexp_replace(lower({strip(c)}), '\\s*px$', '')"
    t = f"case when regexp_matches({t}, '^\\d{{1,3}}(,\\d{{3}})+$') then replace({t}, ',', '') else {t} end"
    return f"case when regexp_matches({t}, '^\\+?(\\d+\\.?\\d*|\\.\\d+)$') and try_cast({t} as double) > 0 then try_cast({t} as double) end"


def source(c: str) -> str:
    return f"nullif(regexp_replace(regexp_extract(lower({strip(c)}), '^([a-z]{{2}}[ _.-]?\\d{{2}})$', 1), '[ _.-]', '', 'g'), '')"


KNOWN = f"known as (select {key('path')} k, min(path) path from image_audit group by 1)"
LATEST = f"latest as (select k, arg_max(r, r.audited_at) r from (select {key('path')} k, image_audit r from image_audit) group by 1)"
ENTITY = r"regexp_extract(lower(regexp_extract(path, '[^/\\]+$', 0)), '^(?:thumb_|copy of )*[a-z][_.-](?:\d{8}[_.-])?([a-z]{2}\d{2})[_.-]?(?:obj)?0*(\d+)', ['c', 'n'])"
REACH = "both_ways as (select u, v from links where u <> v union select v, u from links where u <> v), reach(a, b) as (select u, v from both_ways union select r.a, e.v from reach r join both_ways e on r.b = e.u), grp as (select a, least(a, min(b)) g from reach group by a)"


def _known_pair(table: str, a: str, b: str) -> str:
    return f"select x.path u, y.path v from {table} t join known x on x.k = {key('t.' + a)} join known y on y.k = {key('t.' + b)}"


P2_LINKS = (
    f"links as ({_known_pair('near_duplicate_pairs', 'path_a', 'path_b')} union {_known_pair('dedup_group_pairs', 'path_a', 'path_b')} union "
    f"select x.path u, y.path v from (select i, path from (select row_number() over () i, unnest(string_split(paths, '|')) p from exact_duplicates) join known on k = {key('p')}) x "
    f"join (select i, path from (select row_number() over () i, unnest(string_split(paths, '|')) p from exact_duplicates) join known on k = {key('p')}) y using (i))"
)

HAVE = f"have as (select {label('current_label')} as label, count(distinct {key('path')}) n from manifest_clean where {key('path')} in (select k from known) group by 1)"
NEED = "select request_id, t.label, greatest(cast(round_even(target_share * sample_size, 0) as bigint), min_rows) need, coalesce(n, 0) available from (select distinct * from sample_targets) t left join have using (label)"


def oracle_sql() -> dict[str, str]:
    m = f"manifest as (select distinct path from known where k in (select {key('path')} from manifest_clean)), named as (select path, ({ENTITY}).c || '-' || ({ENTITY}).n entity from manifest)"
    p1 = f"with {KNOWN}, {m} select path, entity from named where entity in (select entity from named where entity <> '-' group by 1 having count(*) > 1)"
    p2 = f"with recursive {KNOWN}, {P2_LINKS}, {REACH} select a as path, g as group_path from grp"
    sizes = "select g group_path, g g, r.path path, r r from grp join latest on r.path = a"
    size_ok = f"{blank('r.error')} and ({number('r.width')}) is not null and ({number('r.height')}) is not null"
    area = f"({number('r.width')}) * ({number('r.height')})"
    p3_links = f"links as ({_known_pair('duplicate_review_actions', 'keep_path', 'remove_path')})"
    p3 = (
        f"with recursive {KNOWN}, {LATEST}, {p3_links}, {REACH}, members as materialized ({sizes}) "
        f"select group_path, 'size' field_name, arg_max(path, row({area}, r.audited_at, path)) path from members where {size_ok} group by 1 union all "
        f"select group_path, 'label', arg_max(path, row(r.audited_at, path)) from members where ({label('r.current_label')}) is not null group by 1 union all "
        f"select group_path, 'source', arg_max(path, row(r.audited_at, path)) from members where {source('r.capture_source')} is not null group by 1"
    )
    split = r"nullif(regexp_extract(lower(source_manifest), '(?:^|[\\/])(train|val|test)_manifest\.', 1), '')"
    ins = f"ins as (select {key('path')} k, bool_or({split} = 'train') tr, bool_or({split} in ('val', 'test')) ev from embedding_manifest where {split} is not null group by 1)"
    p4 = (
        f"with {LATEST}, {ins}, im as materialized (select k, r.path path, tr, ev, case when {blank('r.error')} then {digest('r.sha256')} end d from ins join latest using (k)), "
        f"cand as (select x.path a, y.path b from im x join im y on x.d = y.d where x.ev and y.tr and x.path <> y.path union "
        f"select x.path, y.path from near_duplicate_pairs t join im x on x.k = {key('t.path_a')} join im y on y.k = {key('t.path_b')} where x.path <> y.path and ((x.ev and y.tr) or (x.tr and y.ev)) union "
        f"select path, path from im where tr and ev) select distinct least(a, b) path_a, greatest(a, b) path_b from cand"
    )
    row_no = "try_cast(nullif(regexp_extract(" + strip("embedding_row") + r", '^(\d{1,18})(?:\.0*)?$', 1), '') as bigint)"
    valid = f"lower({strip('valid_embedding')}) in ('1', '1.0', 'true')"
    p7 = (
        f"with v as materialized (select distinct embedding_row r, cast(embedding as double[64]) e from image_vectors where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = 64 "
        f"and len(list_filter(embedding, lambda x: x <> 0)) > 0 and embedding_row in (select {row_no} from embedding_manifest where {valid})), "
        "near as (select a.r a, b.r b, array_cosine_similarity(a.e, b.e) s from v a join v b on a.r <> b.r where array_cosine_similarity(a.e, b.e) >= 0.92), "
        "best as (select a, b from near qualify row_number() over (partition by a order by s desc, b) <= 5) select distinct least(a, b) row_a, greatest(a, b) row_b from best"
    )
    p1_check = (
        f"with {KNOWN}, one as (select {key('path')} k, min({label('current_label')}) l from manifest_clean where {key('path')} in (select k from known) group by 1) "
        "select coalesce(l, 'none') as \"label\", count(*) images, 0::bigint broken, true near from one group by 1"
    )
    last = "arg_max({v}, row({o}, path)) filter ({w})"
    p3_rows = (
        f"with recursive {KNOWN}, {LATEST}, {p3_links}, {REACH}, members as materialized ({sizes}), "
        f"full_size as materialized (select *, case when {size_ok} then {number('r.width')} end w, case when {size_ok} then {number('r.height')} end h, {label('r.current_label')} l, {source('r.capture_source')} s from members) "
        f"select group_path, {last.format(v='w', o='w * h, r.audited_at', w='w is not null')} width, {last.format(v='h', o='w * h, r.audited_at', w='w is not null')} height, "
        f"{last.format(v='l', o='r.audited_at', w='l is not null')} as \"label\", {last.format(v='s', o='r.audited_at', w='s is not null')} source from full_size group by 1"
    )
    p4_im = f"im as materialized (select k, r.path path, {source('r.capture_source')} src, sp, list_contains(sp, 'train') tr, len(list_filter(sp, lambda x: x <> 'train')) > 0 ev, case when {blank('r.error')} then {digest('r.sha256')} end d from (select {key('path')} k, list(distinct {split}) sp from embedding_manifest where {split} is not null group by 1) join latest using (k))"
    p4_report = (
        f"with {LATEST}, {p4_im}, cand as (select x.k a, y.k b from im x join im y on x.d = y.d where x.ev and y.tr and x.k <> y.k union "
        f"select x.k, y.k from (select {key('path_a')} a, {key('path_b')} b from near_duplicate_pairs union select {key('path_b')}, {key('path_a')} from near_duplicate_pairs) t join im x on x.k = t.a join im y on y.k = t.b where x.k <> y.k and x.ev and y.tr union select k, k from im where tr and ev) "
        "select split, coalesce(src, 'unknown') capture_source, count(*) pairs, count(distinct a) images from (select a, src, unnest(list_filter(sp, lambda x: x <> 'train')) split from cand join im on im.k = a) group by 1, 2"
    )
    blanks = r"[ \t\r\n\f]+"
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    p4_texts = (
        f"with spl as (select {key('path')} k, bool_or({split} = 'train') tr, bool_or({split} <> 'train') ev from embedding_manifest where {split} is not null group by 1), "
        f"docs as materialized (select doc_id, tr, ev, list_filter(string_split_regex({low}, '{blanks}'), lambda x: x <> '') w from documents join spl on k = {key('image_path')} where text is not null), "
        "sh as materialized (select doc_id, tr, ev, list_sort(list_distinct(list_transform(range(1, greatest(1, len(w) - 4) + 1), lambda i: array_to_string(w[i:i + 4], ' ')))) s from docs where len(w) > 0), "
        "el as materialized (select doc_id, unnest(s) s from sh), common as (select a.doc_id a, b.doc_id b, count(*) c from el a join el b using (s) where a.doc_id in (select doc_id from sh where ev) and b.doc_id in (select doc_id from sh where tr) and a.doc_id <> b.doc_id group by 1, 2), "
        "link as (select a, count(*) n from common join sh x on x.doc_id = a join sh y on y.doc_id = b where c >= 0.8 * (len(x.s) + len(y.s) - c) - 1e-9 group by 1) "
        "select doc_id, min(doc_id) over (partition by s) class_id, coalesce(n, 0) links from sh left join link on a = doc_id where ev"
    )
    quota = (
        f"with {KNOWN}, {HAVE}, t as (select request_id, label, target_share s, sample_size z, min_rows m, available, need, sum(min_rows) over (partition by request_id) mins from (select t.*, coalesce(n, 0) available, greatest(cast(round_even(target_share * sample_size, 0) as bigint), min_rows) need from (select distinct * from sample_targets) t left join have using (label))), "
        "seat as (select *, row_number() over (partition by request_id order by case when k <= m then 0 else 1 end, case when s > 0 then (k - 0.5) / s else 1e300 end, label) seat from (select *, unnest(range(1, available + 1)) k from t) where k <= m or s > 0), "
        "got as materialized (select request_id, label, count(*) taken from seat where seat <= z group by 1, 2), report as (select t.*, coalesce(taken, 0) taken from t left join got using (request_id, label)) "
    )
    usable = (
        f"usable as (select distinct embedding_row r from image_vectors where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = 64 and len(list_filter(embedding, lambda x: x <> 0)) > 0), "
        f"rows_of as (select distinct {row_no} r, {key('path')} k from embedding_manifest where {valid})"
    )
    name = f"coalesce(nullif(regexp_replace(lower({strip('source')}), '[\\s-]+', '_', 'g'), ''), 'unknown')"
    return {
        "p5_check": f"with {KNOWN}, {usable} select distinct path, 1::bigint clusters, true fits from rows_of join usable using (r) join known using (k)",
        "p7_check": f"with {usable} select distinct r as \"row\", 5::bigint as found, 5::bigint near from rows_of join usable using (r) where r % 50 = 0 and (select count(distinct r) from rows_of join usable using (r)) > 5",
        "p8_check": "select doc_id, sha256(coalesce(text, '')) sha256 from documents",
        "p9_check": "select run_name, (select count(*) from documents) documents, 0::bigint overfull, 0::bigint divided, 0::bigint broken, true near from (select distinct run_name from container_sizes)",
        "p10_check": f"select {name} source, count(*) documents, 0::bigint odd from documents group by 1",
        "p1_check": p1_check,
        "p3_survivors": p3_rows,
        "p4_report": p4_report,
        "p4_texts": p4_texts,
        "p6_report": quota + "select request_id, label, need, available, taken, greatest(0, need - taken) missing, case when need <= taken then '' when need > available then 'too few' when mins > z then 'minima above size' else 'crowded out' end reason from report",
        "p6_check": quota + "select request_id, label, taken as \"rows\", taken images, 0::bigint wrong from report where taken > 0",
        "p1_found": p1,
        "p2_found": p2,
        "p2_group_sizes": f"with recursive {KNOWN}, {P2_LINKS}, {REACH}, s as (select g, count(*) group_size from grp group by 1) select group_size, count(*) as groups from s group by 1",
        "p3_found": p3,
        "p4_found": p4,
        "p6_found": f"with {KNOWN}, {HAVE} select request_id, label from ({NEED}) where need > available",
        "p7_found": p7,
    }
