"""DuckDB SQL for the queries that SQL can express; the others are tested against brute force."""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TERMS = rf"unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))"
_WORDS = r"regexp_extract_all(text, '[^\x20\x09-\x0D]+')"

ORACLE_SQL: dict[str, str] = {
    "op1_mix_sources": f"""
with units as (
  select doc_id, source, md5(coalesce(text, '')) digest, count(*) n, max(coalesce(len({_WORDS}), 0)) size
  from documents group by all),
sizes as (select source, sum(size * n)::bigint source_size from units group by all),
ranked as (
  select *, ([3, 1, 2])[((row_number() over (order by source nulls last)) - 1) % 3 + 1] weight, source_size * 2 cap from sizes),
filling as (
  select *, 1.5::double * sum(source_size) over () - (sum(cap) over w - cap) room, sum(weight) over () - (sum(weight) over w - weight) others
  from ranked window w as (order by cap / weight, source nulls last rows unbounded preceding)),
filled as (select *, cap * others <= room * weight as is_full from filling),
rest_of as (select max(room) room, max(others) others from filled where not is_full),
targets as (
  select source, source_size, case when is_full then cap::double else rest_of.room / rest_of.others::double * weight end target
  from filled, rest_of),
plan as (
  select *, case when source_size > 0 then floor(target / source_size)::bigint else 0 end whole from targets),
hist as (
  select u.source, size, sum(n)::bigint n, max(target - whole * source_size) rest
  from units u join plan p on u.source is not distinct from p.source where size > 0 group by u.source, size),
cut as (
  select *, sum(size * n) over (partition by source order by size desc) - size * n above,
    (sum(size::hugeint * size * n) over (partition by source order by size))::double below from hist),
marked as (select *, (rest - above::double) * size >= below certain from cut),
per as (
  select source, max(rest) - coalesce(sum(size * n) filter (certain), 0)::double rest,
    min(size) filter (certain) certain_from, max(below) filter (not certain) below from marked group by source),
drawn as (
  select u.*, p.rest, size * n words, size >= coalesce(certain_from, 9e18) certain, p.rest / p.below * size chance,
    (('0x' || substr(md5(concat_ws('|', 'mix-1', doc_id, digest)), 1, 13))::bigint::double + 0.5::double) / 4503599627370496::double u
  from units u join per p on u.source is not distinct from p.source where size > 0),
ordered as (
  select *, sum(words) over (partition by source, certain order by (u * (1 - chance)) / ((1 - u) * chance), doc_id nulls last, digest
    rows unbounded preceding) - words before from drawn),
taken as (
  select doc_id, source, digest, certain or (rest > 0 and before::double + words / 2.0::double <= rest) extra from ordered)
select u.doc_id, u.size::bigint size, p.source_size, p.target, u.source,
  (case when u.size > 0 then p.whole + coalesce(t.extra, false)::bigint else 0 end)::bigint copies,
  (u.size * copies)::bigint taken
from units u join plan p on u.source is not distinct from p.source
left join taken t on t.doc_id is not distinct from u.doc_id and t.source is not distinct from u.source and t.digest = u.digest,
  unnest(range(u.n)) repeats
""",
    "op5_exact_dedup": """
select doc_id, max(doc_id) over same keep_id, count(*) over same group_size, doc_id = max(doc_id) over same kept,
  sha256(coalesce(text, '')) text_sha256
from documents window same as (partition by coalesce(text, ''))
""",
    "op8_substring_dedup": f"""
with split as (select doc_id, coalesce({_WORDS}, []) w from documents),
windows as (select doc_id, i, array_to_string(w[i:i + 12], ' ') k from split, unnest(range(1, len(w) - 11)) t(i)),
least as (select k, min(doc_id) first from windows group by k),
gone as (
  select distinct doc_id, i + j i from windows join least using (k), unnest(range(13)) t(j) where first < doc_id),
words as (select doc_id, i, w[i] word from split, unnest(range(1, len(w) + 1)) t(i)),
kept as (select doc_id, string_agg(word, ' ' order by i) kept from words anti join gone using (doc_id, i) group by doc_id),
removed as (select doc_id, count(*) n from gone group by doc_id)
select doc_id, len(w) n_words, coalesce(n, 0) n_removed, sha256(coalesce(kept, '')) kept_sha256
from split left join kept using (doc_id) left join removed using (doc_id)
""",
    "op11_item_search": f"""
with terms as (select doc_id, {_TERMS} term from documents),
counted as (select doc_id, term, count(*) tf from terms group by all),
lengths as (select doc_id, sum(tf)::bigint n from counted group by doc_id),
corpus as (select count(*) all_docs, sum(n)::bigint all_terms from lengths),
weights as (
  select term, floor(1000 * ln((2 * all_docs + 2) / (2 * count(*) + 1)))::bigint w
  from counted, corpus group by term, all_docs),
asked as (select distinct item_id, {_TERMS} term from benchmark),
scores as (
  select item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * all_docs) // all_terms))))::bigint score
  from asked join counted using (term) join weights using (term) join lengths using (doc_id), corpus group by item_id, doc_id),
ranked as (
  select *, row_number() over (partition by item_id order by score desc, doc_id)::int rank from scores where score > 0)
select item_id, rank, doc_id, score from ranked where rank <= 10
""",
    "op13_phrases": f"""
with pieces as (
  select coalesce(lang, 'und') lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\x0A-\x0D]')) piece
  from documents),
words as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') w from pieces),
totals as (select lang, sum(len(w))::bigint n from words group by lang),
counted as (
  select lang, k, w[i:i + k - 1] words, count(*) a
  from words, unnest(range(1, len(w) + 1)) t(i), unnest(range(1, 6)) u(k) where i + k - 1 <= len(w)
  group by all having count(*) >= 100),
inside as (
  select distinct s.lang, s.words
  from counted c, unnest(range(1, c.k)) t(i), unnest(range(2, c.k)) u(k)
  join counted s on s.lang = c.lang and s.words = c.words[i:i + u.k - 1]
  where i + u.k - 1 <= c.k and 100 * c.a >= 100 * s.a),
cuts as (
  select c.lang, c.words, c.a, n, i, l.a l, r.a r, ((1000::hugeint * c.a * n) // (l.a::hugeint * r.a))::bigint score
  from counted c join totals using (lang) anti join inside using (lang, words), unnest(range(1, c.k)) t(i)
  join counted l on l.lang = c.lang and l.words = c.words[1:i]
  join counted r on r.lang = c.lang and r.words = c.words[i + 1:c.k]),
lowest as (
  select *, array_to_string(words, ' ') phrase from cuts
  qualify row_number() over (partition by lang, words order by score, i) = 1),
ranked as (
  select *, row_number() over (partition by lang order by score desc, a desc, phrase) rank from lowest)
select lang, rank, phrase, a, l, r, n, score from ranked where rank <= 2000
""",
}
