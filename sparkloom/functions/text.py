"""Word and text cleaning as column expressions."""

from __future__ import annotations

import zlib
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns of the cleaning rules.
URL = r"(https?|ftp|file)://[-a-zA-Z0-9+&@#/%?=~_|!:,.;]*[-a-zA-Z0-9+&@#/%=~_|]"
W_WORD = r"w.[-a-zA-Z0-9+&@#/%?=~_|!:,.;]*[-a-zA-Z0-9+&@#/%=~_|]"
WWW = r"www[.].*"
MAIL = r"[a-zA-Z0-9_.]+@[a-zA-Z0-9]+.[a-zA-Z0-9]+"
DOTTED = r"^[a-zA-Z]+[.]+([a-zA-Z]?[.]?)*$"
MARKS = ("...", ",", ";", ":", ".", "--", "?", "(", ")", "[", "]", "{", "}", "<", ">", "'", '"', "/")

# Word lists written for this engine; callers pass their own.
ACRONYMS = {"a.s.": "amerika serikat", "d.k.i.": "daerah khusus ibukota", "p.t.": "perseroan terbatas"}
SLANG = {"yg": "yang", "dgn": "dengan", "tdk": "tidak", "the": "der"}
STOPWORDS = ("yang", "dan", "di", "ke", "the", "of", "and", "le", "de", "der", "la")
KEEP_UNSTEMMED = ("makan", "beruang", "main", "is", "this")


def lookup(words: dict[str, str], w: Column) -> Column:
    """The entry of ``w``; a map literal is searched from its start, so many entries go to small maps by checksum."""
    if not words:
        return F.lit(None).cast("string")
    literal = lambda entries: F.create_map(*[F.lit(x) for kv in entries.items() for x in kv]) if entries else F.create_map().cast("map<string,string>")
    if len(words) <= 32:
        return F.element_at(literal(words), w)
    n = len(words) // 8
    parts: list[dict[str, str]] = [{} for _ in range(n)]
    for k, v in words.items():
        parts[zlib.crc32(k.encode()) % n][k] = v
    return F.element_at(F.get(F.array(*[literal(x) for x in parts]), (F.crc32(F.encode(w, "UTF-8")) % n).cast("int")), w)


def split_attached(w: Column) -> Column:
    """A space before a capital inside a word whose neighbour is a small letter or digit."""
    return F.regexp_replace(w, r"(?<!^)(?:(?<=[a-z0-9])([A-Z])|([A-Z])(?=[a-z0-9]))", " $1$2")


def remove_url(w: Column, compat: bool = True) -> Column:
    """Empty for URLs, mail addresses and, in ``compat``, words of URL characters that begin with w."""
    return F.when(w.rlike(f"^(?:{URL}|{W_WORD if compat else WWW}|{MAIL})$"), "").otherwise(w)


def expand_acronym(w: Column, acronyms: dict[str, str] = ACRONYMS) -> Column:
    """Dotted words: their expansion, else without dots."""
    return F.when(w.rlike(DOTTED), F.coalesce(lookup(acronyms, w), F.replace(w, F.lit("."), F.lit("")))).otherwise(w)


def formalise(w: Column, slang: dict[str, str] = SLANG) -> Column:
    return F.coalesce(lookup(slang, w), w)


def remove_symbols(w: Column) -> Column:
    return F.regexp_replace(w, r"[^a-z0-9@$!?.,; :-]", "")


def pad_marks(w: Column) -> Column:
    """Every punctuation mark between spaces, one after another in list order."""
    return reduce(lambda c, m: F.replace(c, F.lit(m), F.lit(f" {m} ")), MARKS, w)


def remove_punctuation(w: Column) -> Column:
    """Other characters become one space before a letter or digit, else nothing."""
    return F.regexp_replace(F.regexp_replace(w, r"[^a-zA-Z0-9-]+(-|$)", "$1"), r"[^a-zA-Z0-9-]+", " ")


def remove_stopword(w: Column, stopwords: tuple[str, ...] = STOPWORDS) -> Column:
    return F.when(w.isin(*stopwords) | w.rlike(r"^[ ?0-9]+$"), "").otherwise(w)


#: Indonesian affixes in the order they are taken off (Porter-style): particles, possessives, prefixes, suffixes.
AFFIXES = ((r"(.{2,}?)(kah|lah|pun)$", "$1"), (r"(.{2,}?)(ku|mu|nya)$", "$1"), (r"^(meng|men|mem|me|peng|pen|pem|di|ter|ke)(.{3,})$", "$2"), (r"^(ber|be|per|pe)(.{3,})$", "$2"), (r"(.{2,}?)(kan|an|i)$", "$1"))


def stem(w: Column, keep: tuple[str, ...] = KEEP_UNSTEMMED) -> Column:
    """Affixes off, unless the word is in the exclusion list."""
    stemmed = reduce(lambda c, rule: F.regexp_replace(c, rule[0], rule[1]), AFFIXES, w)
    return F.when(w.isin(*keep), w).otherwise(stemmed)


def rules(remove: bool = True, compat: bool = True, acronyms: dict[str, str] = ACRONYMS, slang: dict[str, str] = SLANG, stopwords: tuple[str, ...] = STOPWORDS, keep: tuple[str, ...] = KEEP_UNSTEMMED) -> list[Callable[[Column], Column]]:
    """The rules of a word in order; the last three only where ``remove``."""
    steps = [lambda w: F.lower(split_attached(w)), lambda w: remove_url(w, compat), lambda w: expand_acronym(w, acronyms), lambda w: formalise(w, slang), remove_symbols, pad_marks]
    return steps + [remove_punctuation, lambda w: remove_stopword(w, stopwords), lambda w: stem(w, keep)] * remove


def clean_word(w: Column, **options) -> Column:
    """All rules of one word, in order."""
    return reduce(lambda c, rule: rule(c), rules(**options), w)


def sentences(text: Column) -> Column:
    """Parts that end with a sentence mark before white space."""
    return F.split(text, r"(?<=[.!?])\s+")


def words(sentence: Column) -> Column:
    return F.filter(F.split(sentence, r"\s+"), lambda w: w != "")


def cleaned(ws: Column, **options) -> Column:
    """Words after all rules, one pass over the array for each: a rule names its input several times."""
    return F.filter(reduce(lambda c, rule: F.transform(c, rule), rules(**options), ws), lambda w: w != "")


def compose(ws: Column, composites: list[str]) -> Column:
    """Words with the neighbours that form one of ``composites`` ("two words") joined by a space, leftmost first, longest of these."""
    if not composites:
        return ws
    known = {c: c for c in composites}
    sizes = sorted({len(c.split(" ")) for c in composites}, reverse=True)
    first = sorted({c.split(" ")[0] for c in composites})
    none = F.array().cast("array<struct<at:int,n:int,word:string>>")

    def of(ws: Column) -> Column:
        longest = lambda i: F.coalesce(*[F.when(i + n <= F.size(ws) + 1, lookup(known, F.array_join(F.slice(ws, i, F.lit(n)), " "))) for n in sizes])
        begins = F.filter(F.transform(ws, lambda w, i: F.struct((i + 1).alias("at"), w.alias("w"))), lambda x: x["w"].isin(*first))
        named = F.filter(F.transform(begins, lambda x: F.struct(x["at"].alias("at"), longest(x["at"]).alias("word"))), lambda x: x["word"].isNotNull())
        sized = F.transform(named, lambda x: F.struct(x["at"].alias("at"), F.size(F.split(x["word"], " ")).alias("n"), x["word"].alias("word")))
        end = lambda chosen: F.coalesce(F.element_at(F.transform(F.slice(chosen, -1, 1), lambda x: x["at"] + x["n"]), 1), F.lit(1))
        chosen = F.aggregate(sized, none, lambda acc, x: F.when((F.size(acc) == 0) | (x["at"] >= end(acc)), F.concat(acc, F.array(x))).otherwise(acc))

        def joined(c: Column) -> Column:
            before = lambda k: F.coalesce(F.get(c, k - 1)["at"] + F.get(c, k - 1)["n"], F.lit(1))
            parts = F.transform(c, lambda x, k: F.concat(F.slice(ws, before(k), x["at"] - before(k)), F.array(x["word"])))
            last = before(F.size(c))
            return F.concat(F.flatten(parts), F.slice(ws, last, F.greatest(F.size(ws) - last + 1, F.lit(0))))

        return F.element_at(F.transform(F.array(chosen), joined), 1)

    return F.element_at(F.transform(F.array(ws), of), 1)


def clean_text(text: Column, composites: list[str] = (), **options) -> Column:
    """Sentences of cleaned words; empty words and sentences are dropped."""
    each = F.transform(sentences(text), lambda s: cleaned(compose(words(s), composites), **options))
    return F.filter(each, lambda s: F.size(s) > 0)


def clean_tagged(text: Column, tags: dict[str, str] | None = None, **options) -> Column:
    """(word, tag) of every word of each sentence, cleaned without the last three rules."""
    each = F.transform(clean_text(text, remove=False, **options), lambda s: words(F.array_join(s, " ")))
    return F.transform(each, lambda s: tag_words(s, TAGS if tags is None else tags))


def clean_terms(text: Column, **options) -> Column:
    """Cleaned words joined by commas."""
    return F.array_join(F.flatten(clean_text(text, **options)), ",")


def simple_terms(text: Column) -> Column:
    """Lower-case words of letters a-z and digits.

    Other characters go word by word: over a long text at once a pattern that seldom matches takes many times as long.
    """
    plain = lambda w: F.when(w.rlike("[^a-z0-9]"), F.regexp_replace(w, "[^a-z0-9]+", "")).otherwise(w)
    return F.filter(F.transform(F.split(F.lower(text), r"\s+"), plain), lambda w: w != "")


def epoch_ms(ts: Column) -> Column:
    """Milliseconds since 1970 of a time with or without zone."""
    return F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts.cast("timestamp_ntz"))


def domain(url: Column) -> Column:
    """Host without a leading www., null for what is no URL or has no host."""
    return F.regexp_replace(F.try_parse_url(url, F.lit("HOST")), r"^www[.]", "")


#: Part of speech of words, written for this engine; others are nouns.
TAGS = {"the": "DT", "of": "IN", "and": "CC", "is": "VBI", "are": "VBI", "was": "VBT", "not": "NEG", "no": "NEG", "good": "JJ", "bad": "JJ", "her": "PRP", "very": "RB", "et": "CC", "und": "CC", "y": "CC", "nicht": "NEG", "la": "DT", "le": "DT", "de": "IN"}


def tag_words(sentence: Column, tags: dict[str, str] = TAGS, default: str = "NN") -> Column:
    """(word, tag) of every word of an array."""
    return F.transform(sentence, lambda w: F.struct(w.alias("word"), F.coalesce(lookup(tags, w), F.lit(default)).alias("tag")))


# Tags that share a class of the lexicon.
POS_CLASSES = {"NN": "n", "PRP": "n", "NNP": "n", "NNG": "n", "JJ": "a", "RB": "r", "VBI": "v", "VBT": "v"}


def standard_pos(tag: Column) -> Column:
    return F.coalesce(lookup(POS_CLASSES, tag), tag)


def java_bucket(term: Column, bits: int = 20) -> Column:
    """Bucket of the 31-based string hash over UTF-16 code units."""
    units = F.regexp_extract_all(F.hex(F.encode(term, "UTF-16BE")), F.lit(".{4}"), F.lit(0))
    codes = F.transform(units, lambda c: F.conv(c, 16, 10).cast("bigint"))
    return F.aggregate(codes, F.lit(0).cast("bigint"), lambda a, c: (a * 31 + c).bitwiseAND(4294967295)).bitwiseAND((1 << bits) - 1)
