"""The same queries in SQL for DuckDB, to check the results against."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from postlens import queries as q
from postlens.derived import DUCKDB_FORMAT, POSTS_SQL
from postlens.functions import lexicon

POSTS = POSTS_SQL.replace("{S}", "varchar").replace("{FMT}", DUCKDB_FORMAT).format(
    events="events", nation="nation", documents="documents"
)

# What counts as a word character, a blank, a mail address and so on.
W = r"\p{L}\p{N}_"
SPACE = r"\t-\r\x1c-\x1f\x{85}\p{Z}"
EMAIL = rf"[{W}.+-]+@[{W}-]+(\.[{W}-]+)+"
HANDLE = rf"(^|[^@{W}])@([{W}]{{1,15}})\b"
HASHTAG = rf"#([{W}]+)"
URL = rf"https?://[^{SPACE}]+|www\.[^{SPACE}]+"
MARKUP = r"""<("[^"]*"|'[^']*'|[^'">])*>"""
PUNCTUATION = rf"[^{W}{SPACE}]"
EMOJI_STARTS = r"\x{2600}-\x{27BF}\x{1F300}-\x{1FAFF}"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(values: Iterable[str]) -> str:
    return "[" + ", ".join(map(_text, values)) + "]"


def _map(entries: Mapping[str, str]) -> str:
    return "map {" + ", ".join(f"{_text(k)}: {_text(v)}" for k, v in entries.items()) + "}"


def _replace(pattern: str, mark: str, x: str) -> str:
    return f"regexp_replace({x}, {_text(pattern)}, {_text(mark)}, 'g')"


def lower(x):
    return f"lower({x})"


def mask_email(x):
    return _replace(EMAIL, lexicon.EMAIL_MARK, x)


def mask_handle(x):
    return _replace(HANDLE, lexicon.HANDLE_MARK, x)


def mask_hashtag(x):
    return _replace(HASHTAG, lexicon.HASHTAG_MARK, x)


def mask_url(x):
    return _replace(URL, lexicon.URL_MARK, x)


def mask_markup(x):
    return _replace(MARKUP, lexicon.MARKUP_MARK, x)


def strip_punct(x):
    return _replace(PUNCTUATION, "", x)


def squeeze(x):
    return f"trim({_replace(f'[{SPACE}]+', ' ', x)})"


def words(x):
    return f"list_filter(regexp_split_to_array({x}, {_text(f'[{SPACE}]+')}), lambda w: w <> '')"


def stopwords(x):
    listed = _list(sorted(set(lexicon.STOP_WORDS)))
    return (
        f"array_to_string(list_filter({words(x)}, lambda w: not list_contains({listed}, w)), ' ')"
    )


def _segments(x, pattern, entries, key="s"):
    return (
        f"array_to_string(list_transform(regexp_extract_all({x}, {_text(pattern)}), "
        f"lambda s: coalesce({_map(entries)}[{key}], s)), '')"
    )


def contractions(x):
    runs = rf"[{W}'’]+|[^{W}'’]+"
    return _segments(x, runs, lexicon.CONTRACTIONS, "replace(s, '’', '''')")


def emoji(x):
    known = "|".join(sorted(lexicon.EMOJI, key=len, reverse=True))
    pattern = f"{known}|[^{EMOJI_STARTS}]+|[{EMOJI_STARTS}]"
    described = {sequence: f":{name}:" for sequence, name in lexicon.EMOJI.items()}
    return (
        f"case when regexp_matches({x}, {_text(f'[{EMOJI_STARTS}]')}) "
        f"then {_segments(x, pattern, described)} else {x} end"
    )


def lemmas(x):
    return (
        f"array_to_string(list_transform(string_split({x}, ' '), "
        f"lambda w: coalesce({_map(lexicon.LEMMAS)}[w], w)), ' ')"
    )


MASKING = [
    ("case", lower),
    ("email", mask_email),
    ("username", mask_handle),
    ("hashtags", mask_hashtag),
    ("url", mask_url),
    ("markup", mask_markup),
    ("punctuation", strip_punct),
]
# No given text is garbled, so the repair step has nothing to do here.
CHAIN = [
    ("case", lower),
    ("contractions", contractions),
    ("lemmatization", lemmas),
    ("emoji", emoji),
    ("stopwords", stopwords),
    *MASKING[1:],
    ("trim", squeeze),
]


def _name_of(column: str) -> str:
    return column.split(" as ")[-1]


def _chain(table: str, key: str, text: str, steps, ctes: str = "") -> str:
    """CTEs ``c0, c1, ...`` that apply ``steps`` one after the other; the last holds the result."""
    parts = [f"c0 as materialized (select {key}, {text} as x from {table})"]
    for i, (_, step) in enumerate(steps, 1):
        parts.append(f"c{i} as materialized (select {_name_of(key)}, {step('x')} as x from c{i - 1})")
    return f"with {ctes}{', '.join(parts)}"


def _posts(select: str, more: str = "") -> str:
    return f"with posts as ({POSTS}){more} {select}"


def _on_posts(expression: str) -> str:
    return _posts(f"select tweet_id, {expression} as out from posts")


ACTIVE_TAGS = """(values ('sony','Sony'),('sonyindia','Sony'),('sonysupport','Sony'),
 ('panasonic','Panasonic'),('panasonicindia','Panasonic'),('panasonicsupport','Panasonic'),
 ('lg','LG'),('lglifeisgood','LG'),('lgliving','LG')) as a(tag, brand)"""
BRANDED = f"""mentions as (
 select tweet_id, 1 as pos, tag1 as tag from posts union all
 select tweet_id, 2, tag2 from posts union all select tweet_id, 3, rt_tag1 from posts),
branded as (select tweet_id, arg_min(brand, pos) as brand
 from mentions join {ACTIVE_TAGS} on a.tag = regexp_replace(lower(mentions.tag), '^#', '')
 group by tweet_id)"""
DATE = "try_strptime(created_at, '%a %b %d %H:%M:%S +0000 %Y')"
DAY = f"strftime({DATE}, '%Y-%m-%d')"


def _nearest(places: str) -> str:
    return f"""places as ({places}),
spots as (select cc, cos(radians(lat)) * cos(radians(lon)) as x, cos(radians(lat)) * sin(radians(lon)) as y,
 sin(radians(lat)) as z from places),
located as (select tweet_id, cos(radians(lat)) * cos(radians(lon)) as x,
 cos(radians(lat)) * sin(radians(lon)) as y, sin(radians(lat)) as z
 from posts where lat is not null and coalesce(country_code, '') = ''),
ranked as (select tweet_id, min({{'d': round((l.x - s.x) * (l.x - s.x) + (l.y - s.y) * (l.y - s.y)
 + (l.z - s.z) * (l.z - s.z), 14), 'cc': s.cc}}) as best from located l, spots s group by tweet_id),
countries as (select p.tweet_id, coalesce(nullif(p.country_code, ''), r.best.cc) as country
 from posts p left join ranked r on r.tweet_id = p.tweet_id)"""


NATION_PLACES = """select n_name as cc, cast((n_nationkey * 37) % 180 - 90 as double) as lat,
 cast((n_nationkey * 71) % 360 - 180 as double) as lon from nation"""
CUSTOMER_PLACES = """select 'N' || cast(c_nationkey as varchar) as cc,
 case when c_custkey % 3 = 0 then 12 + cast((c_custkey * 17) % 1000 as double) / 1000
  else cast((c_custkey * 7907) % 17989 as double) / 100 - 89.9 end as lat,
 case when c_custkey % 3 = 0 then 77 + cast((c_custkey * 23) % 1000 as double) / 1000
  else cast((c_custkey * 104723) % 35989 as double) / 100 - 179.9 end as lon from customer"""

SUPPLIER_TAGS = """supplier_tags as (
 select tag, arg_max(s_name, s_suppkey) as brand from (
  select s_suppkey, s_name, unnest(['s' || s_suppkey, 's' || s_suppkey || 'support', 'n' || s_nationkey]) as tag
  from supplier where s_suppkey % 10 <> 7 and s_suppkey % 4 <> 1 and s_suppkey % 6 <> 5)
 group by tag)"""

PROFILES = """select '"Suite ' || c_custkey || '", Main St' as address,
 case when c_custkey % 2 = 0 then 'A-' else 'O+' end as blood_group, c_mktsegment as company,
 'clerk' as job, c_name as name, case when c_custkey % 3 = 0 then 'F' else 'M' end as sex,
 'user' || c_custkey as username, c_name || ' || ' || c_mktsegment as website,
 '2021-11-01' as created_at from customer"""

ISO = "'%Y-%m-%dT%H:%M:%S'"
RUNS = f"""runs as (select case when o_orderkey % 50 <> 0 then o_orderdate end as started,
 lpad(cast(o_orderkey as varchar), 12, '0') as run_id, o_orderpriority as task_type,
 case when o_orderstatus = 'F' then 'SUCCESS' else 'ERROR' end as run_status,
 'b' || (o_custkey % 4) as brand, o_orderdate as start_dt, o_orderdate + interval 1 day as end_dt
 from orders)"""
LATEST = """latest as (select * from runs where run_status = 'SUCCESS'
 qualify row_number() over (partition by task_type, brand order by started desc nulls last, run_id desc) = 1)"""


def _latest(condition: str) -> str:
    return f"""with {RUNS} select task_type, run_id, strftime(started, {ISO}) as run_started_at
 from runs where run_status = 'SUCCESS' and {condition}
 order by started desc nulls last, run_id desc limit 1"""


def _plain() -> str:
    return _chain("documents", "doc_id", "text", [("", lower), ("", strip_punct), ("", squeeze)])


def _phrase_step(name: str, source: str, cut: str, dictionary: str, lengths: tuple[int, ...]) -> str:
    """CTEs that rewrite the phrases of ``dictionary`` in ``source(doc_id, x)``; the last is ``name``.

    ``cut`` makes segments of ``x``; a phrase has as many segments as one of ``lengths``. The phrase
    at each place is the longest, and every chosen one leads to the next that does not overlap it.
    """
    starts = " union all ".join(
        f"select doc_id, p, {n} as n, "
        + " || ".join(["s", *(f"lead(s, {i}) over (partition by doc_id order by p)" for i in range(1, n))])
        + f" as phrase from {name}_at"
        for n in lengths
    )
    return f"""{name}_at as materialized (select doc_id, unnest({cut}) as s, unnest(range(1, len({cut}) + 1)) as p
 from {source} where x is not null),
{name}_dict as materialized (select phrase, max(replacement) as r from ({dictionary}) group by phrase),
{name}_met as materialized (select doc_id, p, arg_max(n, n) as n, arg_max({{'r': r}}, n) as r
 from ({starts}) join {name}_dict using (phrase) group by doc_id, p),
{name}_next as materialized (select m.doc_id, m.p, m.n, m.r, f.p as q from {name}_met m
 asof left join {name}_met f on m.doc_id = f.doc_id and m.p + m.n <= f.p),
{name}_taken as (select doc_id, p, n, r, q from {name}_next
  where (doc_id, p) in (select doc_id, min(p) from {name}_met group by doc_id)
 union all select f.doc_id, f.p, f.n, f.r, f.q from {name}_taken t join {name}_next f on f.doc_id = t.doc_id and f.p = t.q),
{name}_parts as (select a.doc_id, a.p, case when t.p = a.p then coalesce(t.r.r, '') when a.p < t.p + t.n then '' else a.s end as part
 from {name}_at a asof left join {name}_taken t on a.doc_id = t.doc_id and a.p >= t.p),
{name} as materialized (select s.doc_id, case when s.x is not null then coalesce(j.x, '') end as x from {source} s left join
 (select doc_id, string_agg(part, '' order by p) as x from {name}_parts group by doc_id) j on j.doc_id = s.doc_id)"""


def _lexicon_tables() -> str:
    word = "'^[a-z]{2,}$'"
    spaced = "regexp_extract_all(x, '[^ ]+| ')"
    runs = _text(rf"[{W}'’]+|[^{W}'’]+")
    steps = [
        _phrase_step(
            "contracted", "lowered", f"regexp_extract_all(x, {runs})",
            "select a || ' ' || b as phrase, a || '_' || b as replacement from neighbours where (length(a) + length(b)) % 5 = 0", (3,),
        ),
        _phrase_step(
            "lemmatized", "contracted", spaced,
            """select a || ' ' || b as phrase, a as replacement from neighbours where (length(a) + length(b)) % 11 = 0 union all
 select a || ' ' || b || ' ' || c, b from neighbours where c is not null and (length(a) + length(b) + length(c)) % 7 = 0""",
            (3, 5),
        ),
        f"plain as (select doc_id, array_to_string({words('x')}, ' ') as x from lemmatized)",
        _phrase_step(
            "dropped", "plain", spaced,
            "select a || ' ' || b as phrase, cast(null as varchar) as replacement from neighbours where (length(a) + length(b)) % 8 = 0", (3,),
        ),
    ]
    return f"""with recursive lowered as materialized (select doc_id, lower(text) as x from documents),
tokens as (select string_split(x, ' ') as t from lowered),
triples as (select t[i] as a, t[i + 1] as b, t[i + 2] as c from (select t, unnest(range(1, len(t) + 1)) as i from tokens)),
neighbours as materialized (select a, b, case when regexp_matches(c, {word}) then c end as c from triples
 where regexp_matches(a, {word}) and regexp_matches(b, {word})),
{", ".join(steps)}
select doc_id, {squeeze(strip_punct(f"array_to_string({words('x')}, ' ')"))} as prepped_text from dropped"""


def _word_counts(tail: str) -> str:
    return (
        f"{_plain()} select word, count(*) as n from "
        f"(select unnest({words('x')}) as word from c3) group by word {tail}"
    )


def _corpus_stats(texts: str) -> str:
    chain = [("retweet", lambda x: f"case when not starts_with({x}, 'RT') then {x} end"), *CHAIN[:-1]]
    # No given text is garbled: the repair step comes after the lemmas and changes nothing.
    chain.insert(4, ("unicode", lambda x: x))
    names = ["start", *[name for name, _ in chain]]
    steps = " union all ".join(
        f"select '{name}' as step, unnest(string_split(x, ' ')) as word from c{i}"
        for i, name in enumerate(names)
    )
    return (
        f"{_chain(texts, '1 as one', 'text', chain, f'posts as ({POSTS}), ')} "
        "select step, cast(count(*) as bigint) as total_words, count(distinct word) as unique_words "
        f"from ({steps}) group by step"
    )


def _lake_rows(select: str) -> str:
    return _posts(
        select,
        """, lake as (select tweet_id, text, event_type as category, 'b' || (user_id % 4) as brand,
 cast(ts as date) as created_at from posts)""",
    )


def _ledger(more: str = "") -> str:
    days = q.INGEST_LENGTH.days
    start = f"timestamp '{q.FIRST_DAY}'"
    return _posts(
        """select run_id, run_status, strftime(s, '%Y-%m-%d') as start_day,
 strftime(e, '%Y-%m-%d') as end_day, case when run_status = 'SUCCESS' then n end as n_rows
 from counted, (values ('RUNNING'), ('SUCCESS')) as t(run_status)"""
        + more,
        f""", windows as (select 'run-' || i as run_id, {start} + to_days(cast(i * {days} as integer)) as s,
  {start} + to_days(cast((i + 1) * {days} as integer)) as e
  from range((select date_diff('day', {start}, max(ts)) // {days} + 1 from posts)) as w(i)),
 counted as (select run_id, s, e, (select count(*) from posts where ts >= s and ts < e) as n from windows)""",
    )


def _enriched(columns: str) -> str:
    chain = _chain("posts", "tweet_id", "text", CHAIN, f"posts as ({POSTS}), ")
    last = len(CHAIN)
    return f"""{chain}, {BRANDED}, {_nearest(NATION_PLACES)},
broken as (select tweet_id, tweet_id % 53 = 0 as b from posts)
select {columns} from (select p.tweet_id,
 case when not b then p.text end as text, case when not b then br.brand end as brand,
 case when not b then co.country end as country, case when not b then {DAY} end as occurred_on,
 case when not b then c.x end as prepped_text
 from posts p join broken using (tweet_id) left join branded br using (tweet_id)
 left join countries co using (tweet_id) join c{last} c using (tweet_id))"""


def _scored(ctes: str, texts: str, key: str, columns: str) -> str:
    """Naive Bayes on TF-IDF of hashed words, learnt from all labelled documents.

    ``texts`` holds ``key, x``; the text ``x`` may be null. ``columns`` read ``texts`` as ``t``.
    """
    chain = _chain("documents", "doc_id", "text", CHAIN, ctes)
    return f"""{chain}, texts as materialized ({texts}),
learn as (select doc_id, 1 - quality as label, x from c{len(CHAIN)} join labels using (doc_id) where x is not null),
terms as (select doc_id, label, substr(md5(w), 1, 3) as b, count(*) as tf
 from (select doc_id, label, unnest(list_filter(string_split(x, ' '), lambda w: w <> '')) as w from learn) group by all),
n as (select count(*) as docs from learn),
buckets as (select printf('%03x', i) as b from range(4096) as r(i)),
idfs as (select b, ln((any_value(docs) + 1) / (count(distinct doc_id) + 1)) as idf
 from buckets left join terms using (b), n group by b),
classes as (select label, ln(count(*) + 1) as pi from learn group by label),
weights as (select label, b, any_value(idf) as idf, coalesce(sum(tf * idf) filter (terms.label is not null), 0) as w
 from (select label, b, idf from classes, idfs) left join terms using (label, b) group by label, b),
thetas as (select label, b, idf, ln(w + 1) - ln(sum(w) over (partition by label) + 4096) as theta from weights),
found as (select {key}, substr(md5(w), 1, 3) as b, count(*) as tf
 from (select {key}, unnest(list_filter(string_split(x, ' '), lambda w: w <> '')) as w from texts) group by all),
sums as (select {key}, label, sum(tf * idf * theta) as s from found join thetas using (b) group by all),
best as (select {key}, arg_max(label, pi + coalesce(s, 0)) as label
 from (select t.{key}, c.label, pi, s from texts t, classes c left join sums on sums.{key} = t.{key} and sums.label = c.label)
 group by {key})
select {columns}, cast(best.label as integer) as "Complaint" from texts t join best using ({key})"""


QUARANTINE = _posts(
    f"""select tweet_id, case when tweet_id % 53 = 0 then 'malformed'
 when created_at is null then 'no date' when {DATE} is null then 'bad date' else 'usable' end as state
 from posts"""
)


def _quarantined(states: str = QUARANTINE) -> str:
    columns = ", ".join(f"case when state = 'usable' then {c} end as {c}" for c in q.ENRICHED)
    return f"""select state, {columns}
 from (select tweet_id as id, state from ({states})) join ({_enriched(f"tweet_id, {', '.join(q.ENRICHED)}")}) on id = tweet_id"""


SQL: dict[str, str] = {
    "incremental_window": _posts(
        f"""select tweet_id, text, date '{q.WINDOW[1]}' as created_at from posts
 where ts >= timestamp '{q.WINDOW[0]}' and ts < timestamp '{q.WINDOW[1]}'"""
    ),
    "lake_json_scan": _lake_rows("select * from lake"),
    "lake_compacted": _lake_rows(
        """select category, brand, created_at, count(*) as n, 1 as n_files, sum(tweet_id) as ids
 from lake group by category, brand, created_at"""
    ),
    "lake_csv_scan": PROFILES,
    "partition_range_scan": _lake_rows(
        f"""select category, brand, created_at, count(*) as n from lake where category = 'click'
 and brand = '{q.BRAND}' and created_at >= date '{q.WINDOW[0]}' and created_at < date '{q.WINDOW[1]}'
 group by all"""
    ),
    "parquet_roundtrip": f"{_chain('documents', 'doc_id', 'text', CHAIN)} "
    f"select doc_id, x as prepped_text from c{len(CHAIN)}",
    "raw_dataset": _lake_rows(
        f"""select tweet_id as id, text, 'Twitter' as source, category, brand, created_at from lake
 where brand = '{q.BRAND}' and created_at >= date '{q.FIRST_DAY.date()}'"""
    ),
    "sql_over_views": _posts(
        """select brand, cast(ts as date) as day, count(*) as n
 from posts left join branded using (tweet_id) group by all""",
        f", {BRANDED}",
    ),
    "profile_reshape": PROFILES,
    "tweet_parse": _posts(
        """select tweet_id, case when ok then text end as text,
 case when ok then country_code end as country_code, case when ok then created_at end as created_at,
 case when ok then array_to_string([x for x in [tag1, tag2] if x is not null], ' ') else '' end as hashtags,
 case when ok then coalesce(rt_tag1, '') else '' end as rt_hashtag,
 case when ok then lon end as lon, case when ok then lat end as lat
 from (select *, tweet_id % 53 <> 0 as ok from posts)"""
    ),
    "quarantine_split": QUARANTINE,
    "retweet_filter": _posts("select tweet_id, text from posts where not starts_with(text, 'RT')"),
    "hash_sample": _posts(
        """select tweet_id, text from posts
 where cast('0x' || substr(md5(cast(tweet_id as varchar)), 1, 8) as bigint) % 1000000 < 100000"""
    ),
    "brand_hashtags": f"with {SUPPLIER_TAGS} select tag, brand from supplier_tags",
    "brand_detect": _posts(
        "select tweet_id, brand from posts left join branded using (tweet_id)", f", {BRANDED}"
    ),
    "brand_detect_large": f"""with {SUPPLIER_TAGS}, mentions as (
 select event_id as tweet_id, 1 as pos, 's' || user_id as tag from events where event_id % 5 <> 0
 union all select event_id, 2, 'n' || (event_id % 25) from events where event_id % 2 = 0),
hits as (select tweet_id, arg_min(brand, pos) as brand from mentions join supplier_tags using (tag) group by 1)
select event_id as tweet_id, brand from events left join hits on tweet_id = event_id""",
    "brand_detect_asof": """with versions as (
 select s_suppkey, s_name, v, unnest(case when v = 1 and s_suppkey % 3 = 0 then ['s' || (s_suppkey + 1)]
   when v = 2 then ['s' || s_suppkey, 's' || s_suppkey || 'support']
   else ['s' || s_suppkey, 's' || s_suppkey || 'support', 'n' || s_nationkey] end) as tag
 from supplier, (values (0), (1), (2)) as t(v)
 where s_suppkey % 10 <> 7 and s_suppkey % 4 <> 1 and s_suppkey % 6 <> 5 and (v <> 1 or s_suppkey % 5 <> 2)),
mentions as (
 select event_id, ts, 1 as pos, 's' || user_id as tag from events where event_id % 5 <> 0
 union all select event_id, ts, 2, 'n' || (event_id % 25) from events where event_id % 2 = 0),
hits as (select event_id, arg_min(s_name, pos * 1000000000 - s_suppkey) as brand from mentions join versions using (tag)
 where v = case when ts < timestamp '2024-01-11 06:30:00' then 0 when ts < timestamp '2024-01-21' then 1 else 2 end group by 1)
select e.event_id as tweet_id, brand from events e left join hits h on e.event_id = h.event_id""",
    "hashtag_union": _posts(
        """select tweet_id, array_to_string(list_transform(kept, lambda s: regexp_replace(lower(s), '^#', '')), ' ')
 as tags from (select tweet_id, [s for s, i in raw if s is not null
 and not list_contains(raw[1:i - 1], s)] as kept
 from (select tweet_id, [tag1, tag2, rt_tag1] as raw from posts))"""
    ),
    "country_resolve": _posts(
        "select tweet_id, country from countries", f", {_nearest(CUSTOMER_PLACES)}"
    ),
    "country_resolve_shuffle": _posts(
        "select tweet_id, country from countries", f", {_nearest(CUSTOMER_PLACES)}"
    ),
    "lemma_table": """with texts as (select doc_id, lower(text) as text from documents),
tokens as (select doc_id, unnest(string_split(text, ' ')) as token,
 generate_subscripts(string_split(text, ' '), 1) as pos from texts),
seen as (select distinct token from tokens),
plurals as (select token, left(token, length(token) - 1) as singular from seen
 where regexp_matches(token, '^[a-z]{3,}s$') and left(token, length(token) - 1) in (select token from seen))
select doc_id, string_agg(coalesce(singular, token), ' ' order by pos) as text
from tokens left join plurals using (token) group by doc_id""",
    "stopword_table": """with texts as (select doc_id, lower(text) as text from documents),
tokens as (select doc_id, unnest(string_split(text, ' ')) as token,
 generate_subscripts(string_split(text, ' '), 1) as pos from texts),
common as (select token from tokens group by token
 having count(distinct doc_id) * 10 >= (select count(*) from documents))
select doc_id, coalesce(string_agg(case when common.token is null then tokens.token end, ' ' order by pos), '') as text
from tokens left join common on common.token = tokens.token group by doc_id""",
    "mask_markup": f"select page_id, {mask_markup('html')} as out from pages",
    "unicode_fix": "select doc_id, text as repaired, text as untouched from documents",
    "clean_text": f"{_chain('posts', 'tweet_id', 'text', CHAIN, f'posts as ({POSTS}), ')} "
    f"select tweet_id, x as prepped_text from c{len(CHAIN)}",
    "clean_lexicon_tables": _lexicon_tables(),
    "clean_documents": f"{_chain('documents', 'doc_id', 'text', CHAIN)} "
    f"select doc_id, x as prepped_text from c{len(CHAIN)}",
    "label_code": """select doc_id, cast(case when quality = 1 then 1 when toxic = 0 then 0 end as integer) as code
 from labels""",
    "iso_times": f"""select o_orderkey, strftime(o_orderdate, {ISO}) as iso,
 strftime(o_orderdate, {ISO}) || 'Z' as utc from orders""",
    "date_spine": """select cast(day as date) as day, count(o_orderkey) as n
 from (select unnest(generate_series(min(cast(o_orderdate as date)), max(cast(o_orderdate as date)), interval 1 day)) as day
 from orders) left join orders on cast(o_orderdate as date) = cast(day as date) group by all""",
    "params_json": f"""with {RUNS} select run_id, '{{"start_dt":"' || strftime(start_dt, {ISO}) || '","end_dt":"'
 || strftime(end_dt, {ISO}) || '","brand":"' || brand || '"}}' as source_query_param, brand,
 strftime(start_dt, {ISO}) as start_dt from runs""",
    "checkpoint_latest": _latest(f"task_type = '{q.TASK}'"),
    "checkpoint_latest_brand": _latest(f"task_type = '{q.TASK}' and brand = '{q.BRAND}'"),
    "checkpoint_latest_all": f"""with {RUNS}, {LATEST} select task_type, brand, run_id,
 strftime(started, {ISO}) as run_started_at from latest""",
    "next_window": f"""with {RUNS}, {LATEST} select task_type, brand, strftime(end_dt, {ISO}) as start_dt,
 strftime(end_dt + interval 1 day, {ISO}) as end_dt from latest""",
    "ingest_ledger": _ledger(),
    "ingest_claims": _ledger(
        """ union all select replace(run_id, 'run', 'second'), 'CLAIMED', strftime(s, '%Y-%m-%d'),
 strftime(e, '%Y-%m-%d'), null from counted"""
    ),
    "ingest_late_rows": _lake_rows(
        """select category, brand, created_at, count(*) as n, count(*) filter (where tweet_id % 23 <> 0) as n_before
 from lake group by category, brand, created_at"""
    ),
    "corpus_stats": _corpus_stats("(select text from documents union all select text from posts)"),
    "corpus_stats_by_day": _corpus_stats("posts"),
    "word_count": _word_counts(""),
    "word_count_top": _word_counts(f"order by n desc, word limit {q.TOP_WORDS}"),
    "stage_counters": _posts(
        f"""unpivot (select count(*) as read, count(*) filter (where starts_with(text, 'RT')) as retweets,
 count(brand) as branded, count({DATE}) as dated, count(lat) as located
 from posts left join branded using (tweet_id)) on * into name counter value n""",
        f", {BRANDED}",
    ),
    "tfidf_terms": f"""{_plain()}, terms as (select doc_id, term, count(*) as tf
 from (select doc_id, unnest({words('x')}) as term from c3) group by all),
idfs as (select term, ln(((select count(*) from documents) + 1) / (count(*) + 1)) as idf from terms group by term)
select doc_id, term, tf, round(idf, 6) as idf, round(tf * idf, 6) as tfidf from terms join idfs using (term)""",
    "mentions_daily": _posts(
        f"""select case when tweet_id % 53 <> 0 then brand end as brand,
 case when tweet_id % 53 <> 0 then {DAY} end as occurred_on, count(*) as n
 from posts left join branded using (tweet_id) group by all""",
        f", {BRANDED}",
    ),
    "tweet_enrich": _enriched(f"tweet_id, {', '.join(q.ENRICHED)}"),
    "tweet_enrich_large": _enriched(f"tweet_id, {', '.join(q.ENRICHED)}"),
    "stream_enrich": _scored(
        "",
        f"select *, prepped_text as x from ({_enriched(f'tweet_id, {", ".join(q.ENRICHED)}')})",
        "tweet_id",
        ", ".join(f"t.{c}" for c in q.ENRICHED),
    ),
    "batch_score": _scored(
        "",
        f"select doc_id, text, x from c{len(CHAIN)} join documents using (doc_id)",
        "doc_id",
        't.doc_id, t.text as "Orig_text", t.x as text',
    ),
    "stream_score": _scored(
        "",
        f"select *, prepped_text as x from ({_enriched(f'tweet_id, {", ".join(q.ENRICHED)}')})",
        "tweet_id",
        ", ".join(f"t.{c}" for c in q.ENRICHED),
    ),
    "stream_quarantine": _quarantined(),
    "stream_manifest": _quarantined(),
    "stream_distinct": _quarantined(
        f"""select tweet_id, case when state = 'usable' and tweet_id % 12 = 0 and ts < timestamp '{q.PARTS[0]}' then 'late'
 else state end as state from ({QUARANTINE}) join (select event_id as tweet_id, ts from events) using (tweet_id)"""
    ),
    "text_lower": _on_posts(lower("text")),
    "mask_email": _on_posts(mask_email("text")),
    "mask_handle": _on_posts(mask_handle("text")),
    "mask_hashtag": _on_posts(mask_hashtag("text")),
    "mask_url": _on_posts(mask_url("text")),
    "strip_punct": _on_posts(strip_punct("text")),
    "squeeze_space": _on_posts(squeeze("text")),
    "stopword_remove": _on_posts(stopwords("lower(text)")),
    "contraction_expand": _on_posts(contractions("lower(text)")),
    "emoji_describe": _on_posts(emoji("text")),
    "lemma_lookup": _on_posts(lemmas("lower(text)")),
    "twitter_date": _on_posts(DAY),
    "twitter_datetime": _on_posts(f"strftime({DATE}, '%Y-%m-%d %H:%M:%S') || '.000'"),
}
