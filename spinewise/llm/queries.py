"""One query for each operator over its whole table, and its check in SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from spinewise.llm.bpe import bpe_digest
from spinewise.llm.common import read
from spinewise.llm.curves import nearest
from spinewise.llm.licenses import license_digest
from spinewise.llm.ngram_join import jaccard_components
from spinewise.llm.packing import pack, piece_digest
from spinewise.llm.prefix_trie import prefix_trie
from spinewise.llm.quality import resample
from spinewise.llm.secrets import secret_digest
from spinewise.llm.sharding import shard_digest
from spinewise.llm.simhash import simhash_components
from spinewise.llm.spelling import spelling_variants
from spinewise.llm.token_files import token_file_digest
from spinewise.llm.topk import exact_top_k


def vocabulary(name: str) -> str:
    """Where a file of the public tokenizers stands; it is read by the driver's and the executors' installed package."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe_digest(read(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_top_k(read(spark, sf_dir, "embeddings"))


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(read(spark, sf_dir, "documents"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digest(read(spark, sf_dir, "documents"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_file_digest(read(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digest(pack(read(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json")))


def op7_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_digest(read(spark, sf_dir, "documents"))


def op8_hilbert_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read(spark, sf_dir, "embeddings"))


def op9_external_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_digest(read(spark, sf_dir, "documents"))


def op10_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(read(spark, sf_dir, "conversations"))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(read(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_exact_top_k": op2_exact_top_k,
    "op3_ngram_jaccard": op3_ngram_jaccard,
    "op4_secret_scan": op4_secret_scan,
    "op5_token_files": op5_token_files,
    "op6_packing": op6_packing,
    "op7_license_rules": op7_license_rules,
    "op8_hilbert_neighbours": op8_hilbert_neighbours,
    "op9_external_shuffle": op9_external_shuffle,
    "op10_importance_resampling": op10_importance_resampling,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_simhash": op12_simhash,
    "op13_spelling_variants": op13_spelling_variants,
}

_TOP_K = """
    with v as (select vec_id, list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as double)) as q from embeddings
               where vec_id is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
    scored as (select a.vec_id as query_id, b.vec_id, cast(list_dot_product(a.q, b.q) as bigint) as score
               from v a join v b on a.vec_id % 20 = 0 and a.vec_id <> b.vec_id and len(a.q) = len(b.q))
    select query_id, rank, vec_id, score
    from (select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank from scored)
    where rank <= 20"""

_JACCARD = """
    with recursive worded as (
        select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as w
        from documents),
    sets as (
        select doc_id, list_distinct(case when len(w) >= 4 then list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))
                                          when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as s from worded),
    shingles as (select doc_id, len(s) as n, unnest(s) as shingle from sets),
    links as (
        select a.doc_id as a, b.doc_id as b from shingles a join shingles b on a.shingle = b.shingle and a.doc_id <> b.doc_id
        group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 85 * (a.n + b.n - count(*))),
    reach(a, b) as (select doc_id, doc_id from sets union select r.a, l.b from reach r join links l on r.b = l.a)
    select doc_id, cast(len(s) as bigint) as n_shingles, (select min(b) from reach where a = doc_id) as component_id from sets"""

#: One step of crc32 (the reflected polynomial 0xEDB88320) over a byte, from a table made by the same rule.
_CRC_TABLE = """
    crc_table as (select list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: xor(c >> 1, (c & 1) * 3988292384)) order by i) as t
                  from (select unnest(range(256)) as i))"""


def _crc32(hexed: str) -> str:
    """crc32 of the bytes given as hexadecimal text, `t` being the table."""
    byte = f"cast('0x' || substr({hexed}, 2 * i + 1, 2) as bigint)"
    steps = f"list_transform(range(length({hexed}) // 2), lambda i: {byte})"
    return f"xor(list_reduce(list_prepend(4294967295, {steps}), lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295)"


_TRIE = f"""
    with recursive {_CRC_TABLE},
    own as (select conv_id, list(struct_pack(r := coalesce(role, ''), x := coalesce(text, '')) order by turn nulls first) as s
            from conversations where conv_id is not null group by conv_id),
    head as (select conv_id, s, {_crc32("hex(cast(conv_id as varchar))")} % 4 as h from own, crc_table),
    built as (select a.conv_id, list_concat(case when b.conv_id is null then [] else b.s[1:a.h] end, a.s[a.h + 1:]) as s
              from head a left join own b on a.conv_id - a.conv_id % 20 = b.conv_id),
    rows as (select conv_id, s, len(s) as size, unnest(range(len(s) + 1)) as depth from built),
    paths as (select conv_id, depth, size, md5(cast(s[1:depth] as varchar) || len(to_json(s[1:depth]))) as path,
                     case when depth > 0 then len(regexp_extract_all(s[depth].x, '[^\\x20\\x09-\\x0D]+')) else 0 end as words from rows),
    nodes as (select path, depth, min(conv_id) as conv_id, count(*) as n_convs, min(words) as words,
                     sha256(coalesce(string_agg(case when size = depth then conv_id end, ',' order by conv_id), '')) as ends_sha256
              from paths group by path, depth),
    links as (select distinct a.path, a.depth, b.path as above from paths a join paths b on a.conv_id = b.conv_id and b.depth = a.depth - 1),
    children as (select above as path, depth - 1 as depth, count(*) as n from links group by all),
    under as (select distinct a.path as top, a.depth as top_depth, b.path, b.depth
              from paths a join paths b on a.conv_id = b.conv_id and b.depth >= a.depth),
    sums as (select u.top, u.top_depth, count(*) filter (coalesce(c.n, 0) = 0) as n_leaves, sum((x.n_convs - 1) * x.words) as saved
             from under u join nodes x on u.path = x.path and u.depth = x.depth
             left join children c on u.path = c.path and u.depth = c.depth group by all)
    select x.conv_id, x.depth, p.conv_id as parent_conv_id, x.n_convs, cast(coalesce(c.n, 0) as bigint) as n_children,
           s.n_leaves, cast(s.saved as bigint) as saved_tokens, x.ends_sha256
    from nodes x join sums s on x.path = s.top and x.depth = s.top_depth
    left join children c on x.path = c.path and x.depth = c.depth
    left join links l on x.path = l.path and x.depth = l.depth
    left join nodes p on l.above = p.path and x.depth - 1 = p.depth"""

_VARIANTS = f"""
    with recursive {_CRC_TABLE},
    runs as (select doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) as w
             from documents),
    counted as (select doc_id, w, count(*) as n from runs where length(w) >= 7 group by all),
    hashed as (select *, {_crc32("hex(coalesce(cast(doc_id as varchar), '') || ':' || w)")} as h from counted, crc_table),
    kept as (select case when h % 31 = 0 then substr(w, 1, cast(h % length(w) as bigint)) || substr(w, cast(h % length(w) as bigint) + 2) else w end as word, n from hashed),
    words as (select word, cast(sum(n) as bigint) as n from kept where length(word) >= 7 group by word having sum(n) >= 2),
    cuts as (select word, n, i, substr(word, 1, i) || substr(word, i + 2) as cut from (select word, n, unnest(range(length(word))) as i from words)),
    near as (select a.word, b.word as other, b.n as m from cuts a join cuts b on a.cut = b.cut and a.i = b.i and a.word <> b.word
             union select a.word, b.word, b.n from cuts a join words b on a.cut = b.word
             union select b.word, a.word, a.n from cuts a join words b on a.cut = b.word),
    counts as (select word, count(*) as n_near from near group by word),
    best as (select word, other, m from near qualify row_number() over (partition by word order by m desc, other) = 1),
    forms as (select w.word, w.n, coalesce(c.n_near, 0) as n_near, case when b.m >= 10 * w.n then b.other end as form, case when b.m >= 10 * w.n then b.m end as form_n
              from words w left join counts c using (word) left join best b using (word)),
    follow(word, here, up) as (select word, word, form from forms
                             union all select f.word, f.up, g.form from follow f join forms g on f.up = g.word where f.up is not null)
    select f.word, f.form, r.here as root, f.n, cast(f.n_near as bigint) as n_near, cast(f.form_n as bigint) as form_n
    from forms f join follow r on f.word = r.word and r.up is null"""

# The multipliers of XXH64.
_PRIMES = [11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261]


def _xxh64(hexed: str, seed: int) -> str:
    """XXH64 of the bytes given as hexadecimal text. Values are 128 bits wide, so that products fit, and cut to 64."""
    p1, p2, p3, p4, p5 = _PRIMES
    wide = lambda x: f"{x % (1 << 64)}::uhugeint"
    cut = lambda x: f"(({x}) & {wide(-1)})"
    times = lambda x, p: cut(f"({x}) * {wide(p)}")
    turned = lambda x, r: f"({cut(f'({x}) * {wide(1 << r)}')} + (({x}) >> {wide(64 - r)}))"
    let = lambda value, name, body: f"list_transform([{value}], lambda {name}: {body})[1]"
    folded = lambda first, items, body: f"list_reduce(list_prepend({first}, {items}), lambda h, x: {body})"
    n = f"(length({hexed}) // 2)"
    byte = lambda at: f"('0x' || substr({hexed}, 2 * ({at}) + 1, 2))::bigint::uhugeint"
    little = lambda at, size: " + ".join(f"{byte(f'({at}) + {k}')} * {wide(1 << 8 * k)}" for k in range(size))
    lanes = lambda low, high, at, size: f"list_transform(range({low}, {high}), lambda i: {little(at, size)})"
    mixed = lambda h, x: let(cut(f"({h}) + {times(x, p2)}"), "z", times(turned("z", 31), p1))
    starts = [seed + p1 + p2, seed + p2, seed, seed - p1]
    four = ", ".join(folded(wide(first), lanes(0, f"{n} // 32", f"i * 32 + {8 * j}", 8), mixed("h", "x")) for j, first in enumerate(starts))
    joined = cut(" + ".join(turned(f"a[{j + 1}]", r) for j, r in enumerate((1, 7, 12, 18))))
    merged = let(f"[{four}]", "a", folded(joined, "a", cut(f"{times(f'xor(h, {mixed(wide(0), "x")})', p1)} + {wide(p4)}")))
    h = cut(f"(case when {n} >= 32 then {merged} else {wide(seed + p5)} end) + {n}::uhugeint")
    h = folded(h, lanes(f"{n} // 32 * 4", f"{n} // 8", "i * 8", 8), let(f"xor(h, {mixed(wide(0), 'x')})", "y", cut(f"{times(turned('y', 27), p1)} + {wide(p4)}")))
    h = folded(h, lanes(f"{n} // 8 * 2", f"{n} // 4", "i * 4", 4), let(f"xor(h, {times('x', p1)})", "y", cut(f"{times(turned('y', 23), p2)} + {wide(p3)}")))
    h = folded(h, lanes(f"{n} // 4 * 4", n, "i", 1), let(f"xor(h, {times('x', p5)})", "y", times(turned("y", 11), p1)))
    for shift, p in ((33, p2), (29, p3)):
        h = let(h, "h", times(f"xor(h, h >> {wide(shift)})", p))
    return let(h, "h", f"xor(h, h >> {wide(32)})")


_SIMHASH = f"""
    with recursive worded as (
        select row_number() over () as r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as w
        from documents),
    grams as (
        select r, unnest(case when len(w) >= 3 then list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))
                              when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as gram from worded),
    counted as (select r, gram, count(*) as n from grams group by all),
    hashed as (select r, n, cast({_xxh64("hexed", 42)} as ubigint) as h from (select r, n, hex(gram) as hexed from counted)),
    bits as (select r, {" + ".join(f"(case when 2 * sum(n * cast((h >> {b}) & 1 as bigint)) > sum(n) then {1 << b}::ubigint else 0::ubigint end)" for b in range(64))} as fp
             from hashed group by r),
    prints as (select w.doc_id, coalesce(b.fp, 0::ubigint) as fp from worded w left join bits b on w.r = b.r),
    nodes as (select distinct fp from prints),
    links as (select a.fp as a, b.fp as b from nodes a join nodes b on bit_count(xor(a.fp, b.fp)::bit) <= 2 and a.fp <> b.fp),
    reach(a, b) as (select fp, fp from nodes union select r.a, l.b from reach r join links l on r.b = l.a),
    least as (select r.a as fp, min(p.doc_id) as component_id from reach r join prints p on r.b = p.fp group by r.a)
    select doc_id, lower(lpad(hex(p.fp), 16, '0')) as fingerprint, component_id from prints p join least l on p.fp = l.fp"""

#: The other operators give ids of tokenizers, places in a hash order, or samples; tests hold them against brute force.
CHECKS: dict[str, str] = {
    "op2_exact_top_k": _TOP_K,
    "op3_ngram_jaccard": _JACCARD,
    "op11_prefix_trie": _TRIE,
    "op12_simhash": _SIMHASH,
    "op13_spelling_variants": _VARIANTS,
}
