"""DuckDB SQL for the queries that SQL can express on whole tables in seconds."""

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

SQL = {}


def crc32(blob: str) -> str:
    """The unsigned crc32 of a blob, bit by bit."""
    bits = "list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, i: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)"
    octets = f"list_transform(range(1, octet_length({blob}) + 1), lambda i: cast('0x' || substr(hex({blob}), 2 * i - 1, 2) as bigint))"
    return f"xor(list_reduce(list_concat([4294967295], {octets}), lambda c, b: {bits}), 4294967295)"

SQL["op2_mixing"] = f"""
with d as (select doc_id, source, cast(len({WORDS}) as bigint) size,
    (cast('0x' || substr(md5(concat_ws('|', '7', coalesce(cast(doc_id as varchar), ''), md5(coalesce(text, '')))), 1, 13) as bigint) + 0.5::double) / 4503599627370496.0::double u
  from documents),
s as (select source, cast(sum(size) as bigint) source_size from d group by source),
w as (select *, cast([5, 2, 1][(row_number() over (order by source nulls last) - 1) % 3 + 1] as double) weight, cast(3 * source_size as double) cap from s),
l as (select *, cap / weight by_weight, cast(sum(source_size) over () as double) - coalesce(sum(cap) over (order by cap / weight, source nulls last rows between unbounded preceding and 1 preceding), 0.0) remaining,
    sum(weight) over (order by cap / weight, source nulls last rows between current row and unbounded following) weights from w),
v as (select *, remaining / weights >= by_weight capped, remaining / weights level from l),
t as (select source, source_size, case when capped then cap else (select arg_min(level, by_weight) from v where not capped) * weight end target from v),
a as (select *, case when source_size > 0 then cast(floor(target / source_size) as bigint) else 0 end whole from t),
b as (select *, greatest(target - whole * source_size, 0.0) rest, case when source_size > 0 then greatest(target - whole * source_size, 0.0) / source_size else 0.0 end share from a),
o as (select d.*, b.source_size, b.target, b.whole, b.rest, b.share, case when share > 0 then u / (1 - u) * ((1 - share) / share) end odds from d join b on d.source is not distinct from b.source),
k as (select *, case when share > 0 then cast(floor(odds / (1 + odds) * 4503599627370496.0::double) as bigint) end rank from o),
c as (select *, sum(size) over (partition by source order by rank) upto from k where share > 0),
x as (select source, min(rank) cut from c where upto > rest group by source),
g as (select x.source, x.cut, any_value(c.rest) - coalesce(sum(c.size) filter (where c.rank < x.cut), 0) gap from x join c on c.source is not distinct from x.source group by x.source, x.cut),
q as (select k.source, min(struct_pack(off := abs(k.size - g.gap), rank := k.rank, gap := g.gap)) e from k join g on k.source is not distinct from g.source where k.rank >= g.cut and k.size > 0 group by k.source)
select k.doc_id, k.size, k.source_size, k.target,
  k.size * (k.whole + case when k.share > 0 and (g.cut is null or k.rank < g.cut or (q.e.off < q.e.gap and k.rank = q.e.rank)) then 1 else 0 end) taken, k.source
from k left join g on k.source is not distinct from g.source left join q on k.source is not distinct from q.source"""

SQL["op3_chat"] = r"""
with c as (select conv_id, turn, coalesce(role, '') role, coalesce(text, '') text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok' union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
b as (select *, case when contains(text, '### ') or contains(text, '</turn>') or text like '% ###' or replace(replace(replace(text, '<\s/turn>', '</turn>'), '#\s## ', '### '), '\\', '\') <> text
    then replace(replace(replace(text, '\', '\\'), '</turn>', '<\s/turn>'), '### ', '#\s## ') else text end body from c)
select conv_id, count(*) n_turns, sha256(string_agg(concat(role, chr(10), text, chr(10)), '' order by turn, role, text)) turns_sha256,
  cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) loss_sha256,
  cast(sum(4 + length(role) + 2 + length(body) + 8) as bigint) formatted_chars, true exact
from b group by conv_id"""

SQL["op6_substrings"] = f"""
with d as (select doc_id, {WORDS} w from documents),
v as (select doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) g from (select doc_id, w, unnest(range(1, len(w) - 33)) i from d where len(w) >= 35)),
s as (select doc_id, i, count(*) over (partition by g) > 1 starts from v),
p as (select doc_id, unnest(w) word, generate_subscripts(w, 1) i from d),
r as (select p.*, coalesce(max(coalesce(s.starts, false)) over (partition by p.doc_id order by p.i rows between 34 preceding and current row), false) gone
  from p left join s on s.doc_id = p.doc_id and s.i = p.i)
select d.doc_id, count(r.word) n_words, count(*) filter (where r.gone) n_removed, sha256(coalesce(string_agg(r.word, ' ' order by r.i) filter (where not r.gone), '')) kept_sha256
from d left join r using (doc_id) group by d.doc_id"""


SQL["op12_runs"] = f"""
with d0 as (select doc_id, {WORDS} w, {crc32("encode(cast(doc_id as varchar))")} h from documents),
d1 as (select *, len(w) n, h // 10 g from d0),
d2 as (select *, case when h % 10 = 0 and n > 0 then g % n end a from d1),
d as (select *, 1 + (n - a) // (3 + g % 8) p from d2),
t as (select doc_id, i, w[case when i >= a then a + (i - a) % p else i end + 1] word from (select *, unnest(range(0, n)) i from d)),
e as (select x.doc_id, x.i, y.i - x.i q from t x join t y on x.doc_id = y.doc_id and x.word = y.word and y.i > x.i join d on d.doc_id = x.doc_id where 4 * (y.i - x.i) <= d.n),
s as (select doc_id, q, min(i) s, count(*) + q len from (select *, i - row_number() over (partition by doc_id, q order by i) k from e) group by doc_id, q, k),
r as (select doc_id, s, len, min(q) q from s where len >= greatest(6, 4 * q) group by doc_id, s, len),
z as (select doc_id, count(*) n_runs, max(struct_pack(len := len, s := -s, q := -q)) best, string_agg(concat(s, ',', len, ',', q, chr(10)), '' order by s, q) lines from r group by doc_id),
gone as (select distinct doc_id, unnest(range(s + q, s + len)) i from r),
kept as (select t.doc_id, string_agg(t.word, ' ' order by t.i) text from t left join gone on gone.doc_id = t.doc_id and gone.i = t.i where gone.i is null group by t.doc_id)
select d.doc_id, coalesce(n_runs, 0) n_runs, -best.s start, best.len length, -best.q period, 1000 * best.len // -best.q exponent_milli,
  sha256(coalesce(lines, '')) runs_sha256, sha256(coalesce(kept.text, '')) collapsed_sha256
from d left join z using (doc_id) left join kept using (doc_id)"""

#: Letters beyond ASCII become single characters, as DuckDB's distance counts bytes.
_LETTERS = "".join(map(chr, range(0xC0, 0x100)))
_CHARACTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789!#$%&()*+,-./:;<=>?@[]^_{|}~"

SQL["op13_spelling"] = f"""
with recursive o as (select doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\u00C0-\u00FF]+')) run from documents),
k as (select doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') run, count(*) n from o group by all),
h as (select run, n, {crc32("b")} h from (select *, encode(concat(doc_id, ':', run)) b from k)),
c as (select case when h % 199 = 0 then concat(substr(run, 1, h % length(run)), substr(run, h % length(run) + 2)) else run end word, n from h),
v as (select word, cast(sum(n) as bigint) n, translate(word, '{_LETTERS}', '{_CHARACTERS}') flat from c where length(word) >= 6 group by word having sum(n) >= 5),
e as (select x.word, x.n, y.word near, y.n near_n from v x join v y on abs(length(x.word) - length(y.word)) <= 1 and x.word <> y.word and levenshtein(x.flat, y.flat) = 1),
f as (select word, count(*) n_near, min(case when near_n >= 5 * n then struct_pack(n := -near_n, form := near) end) best from e group by word),
r as (select v.word, v.n, coalesce(f.n_near, 0) n_near, best.form form, -best.n form_n from v left join f using (word)),
w as (select word, form, word root, 0 depth from r union all select w.word, r.form, r.word, w.depth + 1 from w join r on r.word = w.form)
select r.word, r.form, (select arg_max(root, depth) from w where w.word = r.word) root, r.n, r.n_near, r.form_n from r"""
