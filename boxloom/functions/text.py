"""Column expressions over captions, phrases, labels and model responses."""
from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Words for people and the label that replaces them
PERSON_WORDS = {
    "woman": "person", "women": "persons", "man": "person", "men": "persons",
    "child": "person", "children": "persons", "boy": "person", "boys": "persons",
    "girl": "person", "girls": "persons", "teenager": "person", "teenagers": "persons",
    "adult": "person", "adults": "persons", "senior": "person", "seniors": "persons",
    "male": "person", "females": "persons", "infant": "person", "infants": "persons",
    "toddler": "person", "toddlers": "persons", "youth": "person", "elders": "persons",
    "adolescent": "person", "adolescents": "persons", "baby": "person", "babies": "persons",
    "elderly": "person", "teen": "person", "kid": "person", "kids": "persons",
    "gentleman": "person", "gentlemen": "persons", "lady": "person", "ladies": "persons",
}
# Words treated as 'person' when level-1 objects are written
ADULTS = ["man", "woman", "men", "women"]
# Common English function words (for splitting text into phrases)
STOPWORDS = ("a about above after again all also am an and any are as at be because been before being below between "
             "both but by can could did do does doing down during each few for from further had has have having he "
             "her here hers him his how i if in into is it its itself just may me might more most must my no nor "
             "not now of off on once only or other our out over own per same shall she should so some such than "
             "that the their them then there these they this those through to too under until up upon very was we "
             "were what when where which while who whom why will with would you your").split()


def strip(text: Column) -> Column:
    """A text without white space, line ends included, at both ends."""
    return F.btrim(text, F.lit(" \t\n\r\x0b\x0c"))


def stem(name: Column) -> Column:
    """A file name without its last extension."""
    return F.regexp_replace(name, r"\.[^.]+$", "")


def normalise_person(label: Column) -> Column:
    return F.when(F.lower(label).isin(ADULTS), F.lit("person")).otherwise(label)


def person_word(label: Column) -> Column:
    """The general word for a person word, any other label unchanged."""
    words = F.create_map(*[F.lit(v) for kv in PERSON_WORDS.items() for v in kv])
    return F.coalesce(words[F.lower(label)], label)


# ---- model responses -------------------------------------------------------------------

# What marks tags and caption in an answer
TAG_LIST = r"(?is)TAGS?\s*:\s*\[(.*?)\]"
ANY_LIST = r"(?s)\[(.*?)\]"
CAPTION_TO_TAGS = r"(?is)CAPTION\s*:\s*(.+?)(?=\n\s*(?:TAGS|\z))"
CAPTION_MARK = r"(?i)^CAPTION\s*:\s*"


def parse_tags(response: Column) -> Column:
    """The cleaned, distinct tags of a response: the bracketed list after ``TAGS:``, or else the
    first bracketed list."""
    r = strip(response)
    held = F.when(r.rlike(TAG_LIST), F.regexp_extract(r, TAG_LIST, 1)).otherwise(F.regexp_extract(r, ANY_LIST, 1))
    raw = F.split(held, ",")

    def clean(t: Column) -> Column:
        t = F.regexp_replace(strip(t), r"""^["']|["']$""", "")
        return F.regexp_replace(F.replace(F.lower(t), F.lit(" "), F.lit("_")), r"(?U)[^\w_]", "")

    return F.array_distinct(F.filter(F.transform(raw, clean), lambda t: t != ""))


def parse_caption(response: Column) -> Column:
    """The caption of a response: the text after ``CAPTION:`` where a line with tags follows, or else what
    follows the first bracketed list, its own ``CAPTION:`` taken off; nothing without either; wrapping quotes
    removed."""
    r = strip(response)
    marked = F.regexp_extract(r, CAPTION_TO_TAGS, 1)
    after = strip(F.regexp_replace(r, r"(?s)^.*?\[.*?\]", ""))
    rest = F.when(r.rlike(ANY_LIST), F.regexp_replace(after, CAPTION_MARK, "")).otherwise("")
    c = strip(F.when(r.rlike(CAPTION_TO_TAGS), marked).otherwise(rest))
    wrapped = c.rlike(r"""(?s)^".*"$""") | c.rlike(r"(?s)^'.*'$")
    return F.when(wrapped, strip(c.substr(F.lit(2), F.length(c) - 2))).otherwise(c)


def sentence_count(caption: Column) -> Column:
    return F.size(F.filter(F.split(caption, r"[.!?]+"), lambda s: strip(s) != ""))


def tags_valid(tags: Column) -> Column:
    return F.size(tags).between(3, 12)


def caption_valid(caption: Column) -> Column:
    n = F.length(caption)
    return n.between(20, 800) & (sentence_count(caption).between(2, 8) | n.between(50, 400))


def caption_status(caption: Column, finish_reason: Column | None = None) -> Column:
    """generation_error / empty_caption / caption_too_short / ok of a generated caption."""
    t = strip(caption)
    return (F.when(caption.isNull(), "generation_error").when(t == "", "empty_caption")
            .when(F.length(t) < 10, "caption_too_short").otherwise("ok"))


def truncated(finish_reason: Column) -> Column:
    return F.coalesce(finish_reason == "length", F.lit(False))


def build_prompt(class_name: Column, description: Column, examples: Column | None = None) -> Column:
    """The request for tags and a caption of one image (the wording is this project's own)."""
    head = F.concat(F.lit("Describe the picture. Its class is "), class_name, F.lit(".\nAbout the class: "),
                    F.coalesce(description, F.lit("not known")), F.lit("\n"))
    shown = F.lit("") if examples is None else F.concat(F.lit("Examples:\n"), examples, F.lit("\n"))
    return F.concat(head, shown, F.lit("Answer in two lines.\nTAGS: [about seven lowercase tags]\n"
                                       "CAPTION: three to five plain sentences about what is visible."))


# ---- phrases ---------------------------------------------------------------------------

def normalise_phrase(phrase: Column) -> Column:
    return strip(F.regexp_replace(F.lower(phrase), r"\s+", " "))


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"(?U)\b\w+\b"), F.lit(0))


def contains_run(words: Column, run: Column) -> Column:
    """``run`` occurs in ``words`` as consecutive tokens.  Joined text with marked ends makes
    this one substring search instead of a comparison at every position."""
    mark = lambda a: F.concat(F.lit(" "), F.array_join(a, " "), F.lit(" "))
    return (F.size(words) > 0) & ((F.size(run) == 0) | F.contains(mark(words), mark(run)))


def join_split_words(phrase: Column, vocabulary: Column) -> Column:
    """Glue fragments together until a known word appears; leftovers form the last word."""
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("part"))

    def step(acc: Column, w: Column) -> Column:
        word = F.concat(acc["part"], w)
        known = F.array_contains(vocabulary, word)
        return F.struct(F.when(known, F.concat(acc["done"], F.array(word))).otherwise(acc["done"]).alias("done"),
                        F.when(known, F.lit("")).otherwise(word).alias("part"))

    pieces = F.filter(F.split(strip(phrase), r"\s+"), lambda w: w != "")
    end = lambda acc: F.array_join(F.when(acc["part"] != "", F.concat(acc["done"], F.array(acc["part"]))
                                          ).otherwise(acc["done"]), " ")
    return F.aggregate(pieces, start, step, end)


def similarity(a: Column, b: Column) -> Column:
    """1 for equal strings, falling to 0 with edit distance."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, 1.0).otherwise(1.0 - F.levenshtein(a, b) / longest)


def best_phrase(phrases: Column, caption: Column) -> Column:
    """The phrase all agree on; else the first found in the caption as whole words; else the one
    most like the caption."""
    words = tokens(caption)
    same = F.size(F.array_distinct(phrases)) == 1
    found = F.filter(phrases, lambda p: contains_run(words, tokens(p)))
    scored = F.transform(phrases, lambda p, i: F.struct(similarity(p, caption).alias("s"), (-i).alias("i"), p.alias("p")))
    return (F.when(same, phrases[0])
            .when(F.size(found) > 0, F.array_join(tokens(found[0]), " "))
            .otherwise(F.array_max(scored)["p"]))


def strip_prefix(attribute: Column, lower: bool = False) -> Column:
    """Drop what stands before the first colon; later colons become spaces."""
    parts = F.split(attribute, ":")
    cut = strip(F.array_join(F.slice(parts, F.lit(2), F.size(parts)), " "))
    return F.when(F.contains(attribute, F.lit(":")), F.lower(cut) if lower else cut).otherwise(attribute)


def plural_match(a: Column, b: Column) -> Column:
    """One is the other with an s appended."""
    return (F.concat(b, F.lit("s")) == a) | (F.concat(a, F.lit("s")) == b)


def find_span(phrase: Column, caption: Column) -> Column:
    """First place of a phrase in a caption, ignoring case: 0-based ``[start, end)``, or null."""
    p, c = F.lower(strip(phrase)), F.lower(strip(caption))
    at = F.position(p, c)
    return F.when(at > 0, F.array(at - 1, at - 1 + F.length(p)))


@F.pandas_udf(StringType())
def _nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda v: None if v is None else unicodedata.normalize("NFKC", v))


def clean_unicode(text: Column) -> Column:
    """Doubled backslashes made single and compatibility characters folded; of pure ASCII texts, the
    common case, only nulls are sent to the folding function."""
    single = F.replace(text, F.lit("\\\\"), F.lit("\\"))
    return F.when(single.rlike(r"^[\x00-\x7F]*$"), single).otherwise(_nfkc(F.when(single.rlike(r"[^\x00-\x7F]"), single)))


# Punctuation removed from grounded captions (comma and full stop stay)
PUNCTUATION = "!\"#$%&'()*+-/:;<=>?@[\\]^_`{|}~"


def strip_punctuation(text: Column) -> Column:
    return F.translate(text, PUNCTUATION, "")


def content_words(text: Column) -> Column:
    """Words that carry meaning, in simple singular form."""
    stop = F.array(*[F.lit(w) for w in STOPWORDS])
    words = F.filter(tokens(F.lower(text)), lambda w: ~F.array_contains(stop, w))
    return F.transform(words, lambda w: F.when((F.length(w) > 3) & F.endswith(w, F.lit("s")) & ~F.endswith(w, F.lit("ss")),
                                               w.substr(F.lit(1), F.length(w) - 1)).otherwise(w))


def phrase_similarity(a: Column, b: Column, words_a: Column | None = None, words_b: Column | None = None) -> Column:
    """1 when one phrase contains the other; else the share of the shorter one's content words
    that occur in the longer one.  The content words may be given, where they are known already."""
    short_first = F.length(a) < F.length(b)
    short, long = F.when(short_first, a).otherwise(b), F.when(short_first, b).otherwise(a)
    words = content_words(short) if words_a is None else F.when(short_first, words_a).otherwise(words_b)
    hits = F.size(F.filter(words, lambda w: F.contains(long, w)))
    share = F.coalesce(F.try_divide(hits.cast("double"), F.size(words).cast("double")), F.lit(0.0))
    return F.when(F.contains(a, b) | F.contains(b, a), 1.0).otherwise(share)


def candidate_phrases(caption: Column) -> Column:
    """Runs of words between function words and punctuation, in order, as ``{noun, phrase}``.

    The noun is the last word.  One-word runs are nouns without a phrase and are left out, as are
    phrases already part of an earlier accepted one."""
    stop = "|".join(STOPWORDS)
    cut = F.regexp_replace(F.lower(caption), rf"(?U)\b(?:{stop})\b", "|")
    runs = F.transform(F.split(cut, r"[|.,;:!?()\[\]\"\n]+"), lambda r: strip(F.regexp_replace(r, r"\s+", " ")))
    long = F.filter(runs, lambda r: F.contains(r, F.lit(" ")))
    # accepted phrases are held as one string with marks between, so each test is a single search
    kept = F.aggregate(F.array_distinct(long), F.lit(""), lambda acc, r: F.when(
        F.contains(acc, r), acc).otherwise(F.concat(acc, F.lit("|"), r)))
    return F.transform(F.filter(F.split(kept, r"\|"), lambda p: p != ""), lambda p: F.struct(F.element_at(F.split(p, " "), -1).alias("noun"), p.alias("phrase")))


def single_nouns(caption: Column) -> Column:
    """Runs of exactly one word (see ``candidate_phrases``)."""
    stop = "|".join(STOPWORDS)
    cut = F.regexp_replace(F.lower(caption), rf"(?U)\b(?:{stop})\b", "|")
    runs = F.transform(F.split(cut, r"[|.,;:!?()\[\]\"\n]+"), lambda r: strip(F.regexp_replace(r, r"\s+", " ")))
    return F.filter(runs, lambda r: F.size(tokens(r)) == 1)


def readable(label: Column) -> Column:
    return F.replace(label, F.lit("_"), F.lit(" "))


def label_with_attribute(labels: Column, attribute: Column) -> Column:
    """``label/attribute`` with underscores shown as spaces."""
    return readable(F.concat_ws("/", labels, strip_prefix(attribute)))
