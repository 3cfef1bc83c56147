"""Captions, phrases, labels and model responses."""
from __future__ import annotations

from pyspark.sql import functions as F

from boxloom.functions import text as T
from boxloom.operators import responses as R
from boxloom.plans.registry import query
from boxloom.sources import predictions as P

RESP, CAP = ("responses",), ("captions",)
WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"   # white space at the ends of a text
W = "[\\p{L}\\p{M}\\p{N}_]"     # what the oracle's pattern language needs for a word character
csv = lambda c: F.array_join(c, ",")


def responses(t):
    """Assistant turns, every other one wrapped in the answer form that was asked for."""
    r = t.responses
    first = F.regexp_extract_all(F.lower("response"), F.lit(r"[a-z]+"), F.lit(0))
    wrapped = F.concat(F.lit("TAGS: ["), F.array_join(F.slice(first, 1, 7), ", "), F.lit("]\nCAPTION: "),
                       F.regexp_replace("response", r"\s+", " "))
    return r.withColumn("response", F.when(F.col("image_id") % 2 == 0, wrapped).otherwise(F.concat(F.lit("[One two, Three!, \"four\"] "), "response")))


_RESP = f"""raw as (select image_id, attempt, case when image_id % 2 = 0 then
   'TAGS: [' || array_to_string(regexp_extract_all(lower(response), '[a-z]+')[1:7], ', ') || ']' || chr(10) || 'CAPTION: ' || regexp_replace(response, '\\s+', ' ', 'g')
   else '[One two, Three!, "four"] ' || response end as response, response as body from responses),
 parsed as (select image_id, attempt, case when image_id % 2 = 0 then array_to_string(list_distinct_ordered, ',') else 'one_two,three,four' end as tags,
   trim(case when image_id % 2 = 0 then trim(regexp_replace(body, '\\s+', ' ', 'g')) else trim(body, {WS}) end, {WS}) as caption from (
   select *, list_reduce(regexp_extract_all(lower(body), '[a-z]+')[1:7], lambda acc, x: case when list_contains(acc, x) then acc else list_append(acc, x) end,
     cast([] as varchar[])) as list_distinct_ordered from raw)),
 judged as (select *, case when tags = '' then 0 else len(string_split(tags, ',')) end as n, length(caption) as len,
   len(list_filter(regexp_split_to_array(caption, '[.!?]+'), lambda s: trim(s, {WS}) <> '')) as sentences from parsed)"""


@query("parse_tags", f"with {_RESP} select image_id, attempt, tags from parsed", RESP)
def parse_tags(t):
    return responses(t).select("image_id", "attempt", csv(T.parse_tags(F.col("response"))).alias("tags"))


@query("parse_caption", f"with {_RESP} select image_id, attempt, regexp_replace(caption, '\\s+', ' ', 'g') as caption from parsed", RESP)
def parse_caption(t):
    return responses(t).select("image_id", "attempt", F.regexp_replace(T.parse_caption(F.col("response")), r"\s+", " ").alias("caption"))


@query("validate_response", f"""with {_RESP} select image_id, attempt, n between 3 and 12 as tags_valid,
  len between 20 and 800 and (sentences between 2 and 8 or len between 50 and 400) as caption_valid from judged""", RESP)
def validate_response(t):
    return R.parse_responses(responses(t)).select("image_id", "attempt", "tags_valid", "caption_valid")


_OK = "n between 3 and 12 and len between 20 and 800 and (sentences between 2 and 8 or len between 50 and 400)"


@query("retry_merge", f"""with {_RESP}, good as (select *, row_number() over (partition by image_id order by attempt) as rn from judged
   where {_OK} and attempt < 4), ids as (select distinct image_id from responses)
  select image_id, case when rn = 1 then 'ok' else 'failed' end as status, attempt, tags from ids left join (select * from good where rn = 1) using (image_id)""", RESP)
def retry_merge(t):
    p = R.parse_responses(responses(t))
    return R.retry_merge(p, p.select("image_id").distinct(), attempts=4).select("image_id", "status", "attempt", csv("tags").alias("tags"))


@query("fan_out", f"""with {_RESP}, ok as (select * from judged where {_OK}), m(model) as (values ('blip2'), ('landmark'), ('llava'), ('ram'), ('tag2text'))
  select image_id, attempt, model, case model when 'blip2' then '' when 'landmark' then '{{"category":"Outdoor scene","fine_category":"Natural landscape"}}'
    when 'llava' then regexp_replace(caption, '\\s+', ' ', 'g') when 'ram' then '{{"tags":["' || replace(tags, ',', '","') || '"],"scores":[' || array_to_string(list_transform(string_split(tags, ','), lambda x: '1.0'), ',') || ']}}'
    else '{{"tags":[],"scores":[]}}' end as body from ok, m""", RESP)
def fan_out(t):
    ok = R.parse_responses(responses(t)).where("valid").withColumn("image_id", F.struct("image_id", "attempt"))
    return P.fan_out(ok).select("image_id.image_id", "image_id.attempt", "model",
                                F.when(F.col("model") == "llava", F.regexp_replace("body", r"\s+", " ")).otherwise(F.col("body")).alias("body"))


@query("build_prompt", """select image_id, 'Describe the picture. Its class is ' || class_name || '.' || chr(10) || 'About the class: ' || dataset || chr(10) ||
  'Answer in two lines.' || chr(10) || 'TAGS: [about seven lowercase tags]' || chr(10) || 'CAPTION: three to five plain sentences about what is visible.' as prompt from images""",
       ("images",))
def build_prompt(t):
    return t.images.select("image_id", T.build_prompt(F.col("class_name"), F.col("dataset")).alias("prompt"))


@query("validate_captions", f"""select conv_id, turn, case when text is null or turn = 7 then 'generation_error' when trim(b, {WS}) = '' then 'empty_caption'
   when length(trim(b, {WS})) < 10 then 'caption_too_short' else 'ok' end as status, turn % 4 = 3 as truncated
  from (select *, case when conv_id % 5 = 0 then '  ' when conv_id % 5 = 1 then substring(text, 1, 9) else text end as b from conversations)""")
def validate_captions(t):
    b = F.when(F.col("conv_id") % 5 == 0, F.lit("  ")).when(F.col("conv_id") % 5 == 1, F.substring("text", 1, 9)).otherwise(F.col("text"))
    b = F.when(F.col("turn") != 7, b)
    reason = F.when(F.col("turn") % 4 == 3, "length").otherwise("stop")
    return t.conversations.select("conv_id", "turn", T.caption_status(b).alias("status"), T.truncated(reason).alias("truncated"))


# ---- phrases -----------------------------------------------------------------------------------------

@query("normalise_phrase", "select doc_id, trim(regexp_replace(lower(text), '[ \\t\\n\\r\\f\\v]+', ' ', 'g')) as phrase from documents")
def normalise_phrase(t):
    return t.documents.select("doc_id", T.normalise_phrase(F.col("text")).alias("phrase"))


@query("tokenize", f"select image_id, cast(len(w) as int) as n, w[1] as first, w[-1] as last from (select image_id, regexp_extract_all(caption, '{W}+') as w from captions)", CAP)
def tokenize(t):
    w = t.captions.select("image_id", T.tokens(F.col("caption")).alias("w"))
    return w.select("image_id", F.size("w").alias("n"), F.try_element_at("w", F.lit(1)).alias("first"), F.try_element_at("w", F.lit(-1)).alias("last"))


@query("match_to_caption", f"""select image_id, contains(' ' || array_to_string(w, ' ') || ' ', ' of the ') as has_of_the,
  len(w) > 0 and (len(w) = 1 or contains(' ' || array_to_string(w, ' ') || ' ', ' ' || array_to_string(w[2:4], ' ') || ' ')) as has_own from
  (select image_id, regexp_extract_all(caption, '{W}+') as w from captions)""", CAP)
def match_to_caption(t):
    w = t.captions.select("image_id", T.tokens(F.col("caption")).alias("w"))
    run = F.array(F.lit("of"), F.lit("the"))
    return w.select("image_id", T.contains_run(F.col("w"), run).alias("has_of_the"), T.contains_run(F.col("w"), F.slice("w", 2, 3)).alias("has_own"))


@query("join_split_words", """select image_id, model, seq, case when seq % 2 = 0 then 'class tree' when seq % 3 = 0 then 'green tr' else 'pine apple'
   end as phrase from detections where priority = 1""", ("detections",))
def join_split_words(t):
    given = F.when(F.col("seq") % 2 == 0, "cl ass tr ee").when(F.col("seq") % 3 == 0, " gr een  tr").otherwise("pine apple")
    vocabulary = F.array(*[F.lit(w) for w in ("class", "tree", "green", "apple", "pine")])
    return t.detections.where("priority = 1").select("image_id", "model", "seq", T.join_split_words(given, vocabulary).alias("phrase"))


@query("best_phrase", """select conv_id, turn, case when turn % 3 = 0 then 'same words' when contains(' ' || array_to_string(w, ' ') || ' ', ' zz9 ') then 'zz9'
   else array_to_string(w[2:3], ' ') end as phrase from (select *, regexp_extract_all(text, '[\\p{L}\\p{M}\\p{N}_]+') as w from conversations) where len(w) >= 3""")
def best_phrase(t):
    w = T.tokens(F.col("text"))
    phrases = F.when(F.col("turn") % 3 == 0, F.array(F.lit("same words"), F.lit("same words"))).otherwise(
        F.array(F.lit("zz9"), F.array_join(F.slice(w, 2, 2), " ")))
    return t.conversations.where(F.size(w) >= 3).select("conv_id", "turn", T.best_phrase(phrases, F.col("text")).alias("phrase"))


@query("strip_attribute_prefix", f"""select doc_id, case when contains(url, ':') then trim(replace(substring(url, instr(url, ':') + 1), ':', ' '), {WS}) else url end as plain,
   case when contains(url, ':') then lower(trim(replace(substring(url, instr(url, ':') + 1), ':', ' '), {WS})) else url end as lowered
  from (select page_id as doc_id, case when page_id % 3 = 0 then replace(url, ':', '') when page_id % 3 = 1 then url || ': End' else url end as url from pages)""")
def strip_attribute_prefix(t):
    u = F.when(F.col("page_id") % 3 == 0, F.replace("url", F.lit(":"), F.lit(""))).when(F.col("page_id") % 3 == 1, F.concat("url", F.lit(": End"))).otherwise(F.col("url"))
    return t.pages.select(F.col("page_id").alias("doc_id"), T.strip_prefix(u).alias("plain"), T.strip_prefix(u, lower=True).alias("lowered"))


@query("plural_match", """select image_id, model, seq, case when seq % 3 = 2 then false else true end as same from detections where priority = 2""", ("detections",))
def plural_match(t):
    b = F.when(F.col("seq") % 3 == 0, F.concat("label", F.lit("s"))).when(F.col("seq") % 3 == 1, F.expr("left(label, length(label) - 1)")).otherwise(F.col("label"))
    a = F.when(F.col("seq") % 3 == 1, F.concat(F.expr("left(label, length(label) - 1)"), F.lit("s"))).otherwise(F.col("label"))
    return t.detections.where("priority = 2").select("image_id", "model", "seq", T.plural_match(a, b).alias("same"))


@query("find_span", f"""select doc_id, case when instr(c, p) > 0 then instr(c, p) - 1 end as start, case when instr(c, p) > 0 then instr(c, p) - 1 + length(p) end as "end"
  from (select doc_id, lower(trim(text, {WS})) as c, case when doc_id % 2 = 0 then 'the' else lower(trim(substring(text, 11, 8), {WS})) end as p from documents)""")
def find_span(t):
    p = F.when(F.col("doc_id") % 2 == 0, " The ").otherwise(F.substring("text", 11, 8))
    s = T.find_span(p, F.col("text"))
    return t.documents.select("doc_id", s[0].cast("long").alias("start"), s[1].cast("long").alias("end"))


@query("clean_unicode", "select doc_id, replace(text, chr(92) || chr(92), chr(92)) as text from documents where not regexp_matches(text, '[^\\x00-\\x7F]')")
def clean_unicode(t):
    """The SQL side has no compatibility folding, so texts in plain ASCII are compared."""
    return t.documents.where(~F.col("text").rlike(r"[^\x00-\x7F]")).select("doc_id", T.clean_unicode(F.col("text")).alias("text"))


@query("fold_unicode")
def fold_unicode(t):
    """All texts with compatibility characters folded."""
    return t.documents.select("doc_id", T.clean_unicode(F.col("text")).alias("text"))


@query("strip_punctuation", """select page_id, regexp_replace(html, '[!"#$%&''()*+/:;<=>?@\\[\\\\\\]^_`{|}~-]', '', 'g') as html from pages""")
def strip_punctuation(t):
    return t.pages.select("page_id", T.strip_punctuation(F.col("html")).alias("html"))


_STOP = ", ".join(f"'{w}'" for w in T.STOPWORDS)
_CW = f"""list_transform(list_filter(regexp_extract_all(lower(sh), '{W}+'), lambda w: not list_contains([{_STOP}], w)),
   lambda w: case when length(w) > 3 and ends_with(w, 's') and not ends_with(w, 'ss') then left(w, length(w) - 1) else w end)"""


@query("phrase_similarity", f"""with p as (select b.item_id, d.conv_id, d.turn, b.text as a, d.text as b from benchmark b join conversations d on b.item_id = d.conv_id % 40),
  s as (select *, case when length(a) < length(b) then a else b end as sh, case when length(a) < length(b) then b else a end as lo from p),
  w as (select *, {_CW} as words from s)
  select item_id, conv_id, turn, round(case when contains(a, b) or contains(b, a) then 1.0 when len(words) = 0 then 0.0
    else cast(len(list_filter(words, lambda w: contains(lo, w))) as double) / len(words) end, 6) as similarity from w""")
def phrase_similarity(t):
    a = t.benchmark.select("item_id", F.col("text").alias("a"))
    b = t.conversations.select((F.col("conv_id") % 40).alias("item_id"), "conv_id", "turn", F.col("text").alias("b"))
    return a.join(b, "item_id").select("item_id", "conv_id", "turn", F.round(T.phrase_similarity(F.col("a"), F.col("b")), 6).alias("similarity"))



# Words and other characters get marks around them, so that each function word can be matched on its own
_CUT = f"""cut as (select image_id, replace(regexp_replace(chr(1) || regexp_replace(lower(caption), '([^\\p{{L}}\\p{{M}}\\p{{N}}_])', chr(1) || '\\1' || chr(1), 'g') || chr(1),
   chr(1) || '({'|'.join(T.STOPWORDS)})' || chr(1), '|', 'g'), chr(1), '') as c from captions),
 runs as (select image_id, list_transform(regexp_split_to_array(c, '[|.,;:!?()\\[\\]"\\n]+'), lambda r: trim(regexp_replace(r, '[ \\t\\n\\r\\f\\v]+', ' ', 'g'))) as r from cut)"""


@query("extract_phrases", f"""with {_CUT}, l as (select image_id, list_filter(r, lambda x: contains(x, ' ')) as r from runs),
 k as (select image_id, list_reduce(r, lambda acc, x: case when len(list_filter(acc, lambda y: contains(y, x))) > 0 then acc else list_append(acc, x) end, cast([] as varchar[])) as k from l)
 select image_id, cast(i - 1 as int) as pos, string_split(k[i], ' ')[-1] as noun, k[i] as phrase from (select image_id, k, unnest(range(1, len(k) + 1)) as i from k)""", CAP)
def extract_phrases(t):
    """Noun and phrase pairs of every caption."""
    from boxloom.operators.ground import caption_phrases

    return caption_phrases(t.captions)


@query("noun_lookup", f"with {_CUT} select image_id, cast(len(list_filter(r, lambda x: len(regexp_extract_all(x, '{W}+')) = 1)) as int) as nouns from runs", CAP)
def noun_lookup(t):
    return t.captions.select("image_id", F.size(T.single_nouns(F.col("caption"))).alias("nouns"))


@query("label_with_attribute", """select image_id, model, seq, replace(label || '/' || case when seq % 2 = 0 then 'small one' else 'tall_one' end, '_', ' ') as shown
  from detections where priority = 3""", ("detections",))
def label_with_attribute(t):
    attr = F.when(F.col("seq") % 2 == 0, "size: small one").otherwise("tall_one")
    return t.detections.where("priority = 3").select("image_id", "model", "seq", T.label_with_attribute(F.col("label"), attr).alias("shown"))


@query("person_words", """select conv_id, turn, cast(len(list_filter(regexp_extract_all(text, '[\\p{L}\\p{M}\\p{N}_]+'),
   lambda w: list_contains([""" + ", ".join(f"'{w}'" for w in T.PERSON_WORDS) + """], lower(w)))) as int) as people from conversations""")
def person_words(t):
    general = F.transform(T.tokens(F.col("text")), lambda w: T.person_word(w) != w)
    return t.conversations.select("conv_id", "turn", F.size(F.filter(general, lambda v: v)).alias("people"))
