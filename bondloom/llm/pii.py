"""Finding and replacing personal details in free text by what the corpus discloses.

A first pass over all texts counts how often a term stands in a protected place: a word where
people are announced, the shape of a number after a word that announces phones or identities,
the last word of a street's name before a town and its postcode. A term's share of such places,
against that of terms at large, is its disclosure; words that announce numbers are learnt from
a few seeds the same way, and the beginnings and endings of disclosing words lend theirs to words
alike. The second pass cuts candidates out of the texts. They meet the terms in a join, so what
is disclosed may be as large as it likes; accepted ones are put together document by document
and stand for their type.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections import Counter
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bondloom.session import broadcast_if_small, checkpointed

# Words that announce a person, and seeds of those that announce numbers.
TITLES = ("Mr", "Mrs", "Ms", "Dr", "Prof", "Miss", "Rev")
PERSON_CUES = ("Contact:", "ask for", "name of", "Holder", "holder", "spoke w/", "cc", "From:", "Regards,", "Attn:", "Attn")
SEEDS = {"phone": ("mobile", "phone", "tel"), "id": ("nic", "passport", "identity")}

#: A term discloses if at least this share of its occurrences stands in a protected place
#: and it is this many times likelier to stand there than a term at large.
SHARE, LIFT, SUPPORT = 0.15, 4.0, 3
#: A word announces numbers of a kind if so much of those after it have a disclosing shape.
CUE_SHARE = 0.5
#: A shape belongs to a seed if at least this share of it stands after one.
SEED_SHARE = 0.05
#: The most frequent words that disclose nothing, which the second pass need not look up. Words
#: beyond them are looked up; the list only saves work.
SKIPPED = 1 << 16
#: An ending or beginning discloses if so much of its different words does.
AFFIX_SHARE, AFFIX_WORDS = 0.5, 3
#: A word of disclosing affixes that is seen so often, and so seldom in a protected place.
PLAIN_SUPPORT, PLAIN_SHARE = 20, 0.03
#: The affixes' length; endings one letter shorter need PAIR_WORDS words.
AFFIX, PAIR_WORDS, PAIR_SHARE = 3, 8, 0.6
#: Words up to this length may be a name in capitals and something else in small letters.
SHORT = 4

_OR = "|".join
_TITLE = rf"(?:(?:{_OR(TITLES)})\.?)"
_NAMES = r"((?:[A-Z][A-Za-z]*(?:\.? |-|, )){0,2}[A-Z][A-Za-z]+|[a-z]+ [a-z]+)"
_BESIDE = re.compile(rf"(?<![A-Za-z]){_NAMES}(?=(?:, | / | \(| <|; )\x00)")
_WORD = re.compile(r"(?<![A-Za-z0-9])[A-Za-z]{2,}(?![A-Za-z0-9])")
#: Runs of letters and digits: the words are those of letters alone, found faster.
_RUN = re.compile(r"[A-Za-z0-9]+")
_AT = re.compile(r"@|\s?[(\[{]\s?(?:at|AT)\s?[)\]}]\s?|\s(?:at|AT)\s(?=\w+\s(?:dot|DOT)\s)")
_DOMAIN = re.compile(
    r"[A-Za-z0-9\-]+(?:(?:\.|\s?[(\[{]\s?(?:dot|DOT)\s?[)\]}]\s?|\s(?:dot|DOT)\s)[A-Za-z0-9\-]+)*"
    r"(?:\.|\s?[(\[{]\s?(?:dot|DOT)\s?[)\]}]\s?|\s(?:dot|DOT)\s)[A-Za-z]{2,}"
)
_PHONE_AT = re.compile(r"[+(0]")
_PHONE = re.compile(r"(?<![\w/.,+\-(])(?:\+\d{1,3}|\(\d{2,4}\)|0\d{1,4})(?:[ .\-]?(?:\(\d\)|\d)){5,12}(?![\w/])(?![.\-,]\d)")
_DIGITS = re.compile(r"[0-9]{5,}")
_SPACED_AT = re.compile(r"[0-9]{2} [0-9]{3} [0-9]{4} [VXvx]")
_ID = re.compile(r"(?<![\w/.\-])(?:[A-Z]{1,2}\d{6,8}|\d{12}|\d{2} \d{3} \d{4} [VXvx]|\d{5}-\d{4}-[VXvx]|\d{5,10}[VXvx])(?![\w/\-])(?!\.\d)")

# An address is written in capitals throughout or, after "no", in small letters. Which words
# end a street's name is for the corpus to say; a name has up to three words before it. Towns
# are taken up to two words, the second only if it is known or nothing but a stop follows.
_UNIT = r"(?:[A-Z][a-z]+\.? \d{1,4}[A-Za-z]?, )?"
_NUM = r"(?:No\.? )?\d{1,4}(?:/\d{1,3}|/[A-Z]|[A-Z])?,?"
_BIG, _LITTLE = r"[A-Z][a-z]+\b", r"[a-z]+\b"
_STREET = r"(?P<s{0}>[A-Z][a-z]+(?: [A-Z][a-z]+){{1,3}})\b\.?"
_SMALL = r"no \d{1,4}(?:/\d{1,3}|/[a-z]|[a-z])?,? (?P<sc>[a-z]+(?: [a-z]+){1,3})\b\.?"
_CITY = r"(?P<t{0}>,[ \n] ?(?P<c{0}>{1}(?: {1})?)(?P<z{0}> \d{{5}}\b)?)"
_ADDRESS = re.compile(
    rf"(?<![\w/.,\-])(?:(?P<ua>{_UNIT}){_NUM} {_STREET.format('a')}{_CITY.format('a', _BIG)}?"
    rf"|{_SMALL}{_CITY.format('c', _LITTLE)}"
    rf"|{_BIG}(?: {_BIG})? (?P<zd>\d{{5}}),[ \n] ?{_STREET.format('d')} \d{{1,4}}[A-Z]?\b"
    rf"|(?P<ub>{_UNIT}){_STREET.format('b')} \d{{1,4}}[A-Z]?\b{_CITY.format('b', _BIG)})"
)
#: What every address has: a number before two names, after one, or after "no".
_ADDRESS_AT = re.compile(r"[0-9/][A-Z]?(?:,[ \n] ?[A-Z]|,? [A-Z][a-z]+ [A-Z][a-z])")
_SMALL_AT = re.compile(r"no [0-9]")
_STOPPED = re.compile(r"\s*(?:[^\w\s]|\n|$)")


def _term(word: str) -> str:
    """A word as a term: a short one in capitals is another than in small letters."""
    return word.title() if len(word) <= SHORT and word[0].isupper() else word.lower()


def shape_of(number: str) -> str:
    """Digits as #, a closing check letter as v, other letters as they are."""
    return re.sub(r"[VXvx]$", "v", re.sub(r"\d", "#", number))


def before(text: str, at: int) -> tuple[str, str]:
    """The word before a place on its line, and the last two, in small letters; empty if none."""

    def word(end: int) -> tuple[int, int]:
        while end > 0 and not text[end - 1].isalnum() and text[end - 1] != "\n":
            end -= 1
        start = end
        while start > 0 and text[start - 1].isalpha() and text[start - 1].isascii():
            start -= 1
        return start, end

    start, end = word(at)
    if start == end:
        return "", ""
    first, last = word(start)
    return text[start:end].lower(), f"{text[first:last]} {text[start:end]}".lower() if first < last else ""


def numbers(text: str) -> Iterator[tuple[str, int, int]]:
    """(kind, start, end) of what may be an identity or a phone number. A place to begin is
    found by its first characters, so texts without one cost one scan."""
    for found in _DIGITS.finditer(text):
        # One or two capitals may stand before the digits.
        for start in (found.start() - 2, found.start() - 1, found.start()):
            match = _ID.match(text, start) if start >= 0 else None
            if match and match.end() >= found.end():
                yield "id", match.start(), match.end()
                break
    if " V" in text or " v" in text or " X" in text or " x" in text:
        for found in _SPACED_AT.finditer(text):
            match = _ID.match(text, found.start())
            if match:
                yield "id", match.start(), match.end()
    done = 0
    for found in _PHONE_AT.finditer(text):
        if found.start() >= done:
            match = _PHONE.match(text, found.start())
            if match:
                done = match.end()
                yield "phone", match.start(), done


_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_.+-")


def mails(text: str) -> Iterator[tuple[int, int]]:
    """Spans of mail addresses, however they are spelt: their form is all that they need."""
    if any(mark in text for mark in _ODD) or (" dot " in text.lower() and " at " in text.lower()):
        places = [m.span() for m in _AT.finditer(text)]
    elif "@" in text:
        places = list(_each(text, "@"))
    else:
        return
    done = 0
    for end, after in places:
        start = end
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        while start < end and not (text[start].isalnum() and text[start] != "_"):
            start += 1
        domain = _DOMAIN.match(text, after) if start < end and text[end - 1].isalnum() else None
        if domain:
            done = domain.end()
            yield start, done


#: What a spelt-out "at" may look like.
_ODD = ("(at", "( at", "[at", "[ at", "{at", "{ at", "(AT", "( AT", "[AT", "[ AT", "{AT", "{ AT")


def _each(text: str, mark: str) -> Iterator[tuple[int, int]]:
    at = text.find(mark)
    while at >= 0:
        yield at, at + len(mark)
        at = text.find(mark, at + 1)


def _masked(text: str) -> str:
    """``text`` with mail addresses as one mark each: they repeat their owner's name."""
    out, at = [], 0
    for start, end in mails(text):
        out += [text[at:start], "\0"]
        at = end
    return "".join([*out, text[at:]]) if at else text


_AFTER_TITLE = re.compile(rf"\.?\s+(?:{_TITLE}\s+)?{_NAMES}")
_AFTER_CUE = re.compile(rf"\s+(?:{_TITLE}\s+)?{_NAMES}")


def _announced(text: str) -> Iterator[tuple[int, int]]:
    """Spans of what stands where people are announced: after titles and cues, beside mail."""
    for words, after in ((TITLES, _AFTER_TITLE), (PERSON_CUES, _AFTER_CUE)):
        for word in words:
            at = text.find(word)
            while at >= 0:
                if at == 0 or not (text[at - 1].isalnum() or text[at - 1] == "_"):
                    match = after.match(text, at + len(word))
                    if match:
                        yield match.span(1)
                at = text.find(word, at + 1)
    if "\0" in text:
        for match in _BESIDE.finditer(text):
            yield match.span(1)


def addresses(text: str) -> Iterator[re.Match]:
    if _ADDRESS_AT.search(text) or ("no " in text and _SMALL_AT.search(text)):
        yield from _ADDRESS.finditer(text)


def _second_word(text: str, start: int, end: int) -> str:
    """The second word of a town of two before a postcode of five digits, else nothing."""
    if end - start != 5 or not text[start - 1 : start] == " " or text[end : end + 1].isalnum():
        return ""

    def capital(stop: int) -> int:
        at = stop
        while at > 0 and "a" <= text[at - 1] <= "z":
            at -= 1
        return at - 1 if 0 < at < stop and "A" <= text[at - 1] <= "Z" else -1

    second = capital(start - 1)
    first = capital(second - 1) if second > 1 and text[second - 1] == " " else -1
    return text[second : start - 1].lower() if first >= 0 and not text[first - 1 : first].isalnum() else ""


def _town(found: re.Match, g: str) -> str:
    """The first word of an address' town in small letters, empty if it names none."""
    if g == "d":
        return found.group().partition(" ")[0].lower()
    return (found[f"c{g}"] or "").partition(" ")[0].lower()


def count_terms(text: str, counts: Counter) -> None:
    """Adds (kind, term, context, in a protected place) of one text to ``counts``; words are
    counted by ``Counter`` itself."""
    for kind, start, end in numbers(text):
        one, two = before(text, start)
        counts[kind, shape_of(text[start:end]), one, two, False] += 1
    for code in _DIGITS.finditer(text):
        word = _second_word(text, *code.span())
        if word:
            counts["site", word, "", "", True] += 1
    for found in addresses(text):
        g = next(g for g in "acdb" if found[f"s{g}"])
        town = _town(found, g)
        counts["street", found[f"s{g}"].rpartition(" ")[2].lower(), town, "", False] += 1
        if found[f"z{g}"]:
            counts["town", town, "", "", True] += 1
        unit = found["ua"] or found["ub"]
        if unit:
            counts["unit", unit.partition(" ")[0], town, "", False] += 1
    masked = _masked(text)
    for word in {w.span(): w.group() for a, b in set(_announced(masked)) for w in _WORD.finditer(masked, a, b)}.values():
        if word.title() not in TITLES:
            counts["word", _term(word), "", "", True] += 1


_COUNTED = "kind string, term string, one string, two string, n long, announced long"


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        counts: Counter = Counter()
        words: Counter = Counter()
        for text in batch["text"]:
            if text:
                count_terms(text, counts)
                words.update(_RUN.findall(_masked(text)))
        for word, n in words.items():
            if len(word) > 1 and word.isalpha():
                counts["word", _term(word), "", "", False] += n
        rows = [(*key[:4], *((0, n) if key[4] else (n, 0))) for key, n in counts.items()]
        yield pd.DataFrame(rows, columns=[c.split()[0] for c in _COUNTED.split(", ")])


def disclosure(documents: DataFrame, text: str = "text") -> DataFrame:
    """(kind, term, one, two, n, announced) of every term of the corpus, summed per batch first."""
    counts = documents.select(F.col(text).alias("text")).mapInPandas(_counted, _COUNTED)
    return counts.groupBy("kind", "term", "one", "two").agg(F.sum("n").alias("n"), F.sum("announced").alias("announced"))


def number_terms(counts: DataFrame) -> DataFrame:
    """(ask): shapes of numbers, and the words before them, that disclose.

    A seed's numbers give their shapes; words whose numbers mostly have such shapes announce
    too; and a shape discloses whose share after any announcing word reaches SHARE.
    """
    rows = checkpointed(counts.where("kind in ('phone', 'id')").select("kind", "term", "one", "two", "n"))
    seeded = F.lit(False)
    for kind, seeds in SEEDS.items():
        seeded = seeded | ((F.col("kind") == kind) & (F.col("one").isin(*seeds) | F.split("two", " ")[0].isin(*seeds)))
    share = lambda said: (F.sum(F.when(said, F.col("n")).otherwise(0)) / F.sum("n")).alias("share")
    many = F.sum("n").alias("all")
    shapes = rows.groupBy("kind", "term").agg(share(seeded), many).where((F.col("share") >= SEED_SHARE) & (F.col("all") >= SUPPORT)).select("kind", "term", F.lit(True).alias("shaped"))
    known = rows.join(shapes, ["kind", "term"], "left").withColumn("shaped", F.coalesce("shaped", F.lit(False)))
    contexts = known.select("kind", "n", "shaped", F.explode(F.array_distinct(F.array("one", "two"))).alias("context")).where("context <> ''")
    cues = contexts.groupBy("kind", "context").agg(share(F.col("shaped")), many).where(F.col("all") >= SUPPORT)
    cues = checkpointed(cues.select("kind", "context", (F.col("share") >= CUE_SHARE).alias("announces")))
    # Two words that are known decide, else the last one.
    one = cues.select("kind", F.col("context").alias("one"), F.col("announces").alias("by_one"))
    two = cues.select("kind", F.col("context").alias("two"), F.col("announces").alias("by_two"))
    again = rows.join(one, ["kind", "one"], "left").join(two, ["kind", "two"], "left").withColumn("said", seeded | F.coalesce("by_two", "by_one", F.lit(False)))
    good = again.groupBy("kind", "term").agg(share(F.col("said")), F.sum(F.when(F.col("said"), F.col("n")).otherwise(0)).alias("announced")).where((F.col("share") >= SHARE) & (F.col("announced") >= SUPPORT))
    ask = lambda mark, c: F.concat(F.lit(mark), F.col("kind"), F.lit(":"), F.col(c)).alias("ask")
    fixed = counts.sparkSession.createDataFrame([(f"before:{k}:{w}",) for k, words in SEEDS.items() for w in words], "ask string")
    said = F.when(F.col("announces"), "before:").otherwise("plain:")
    return good.select(ask("shape:", "term")).unionByName(cues.select(F.concat(said, F.col("kind"), F.lit(":"), F.col("context")).alias("ask"))).unionByName(fixed).distinct()


def word_terms(counts: DataFrame) -> DataFrame:
    """(term, n, accepted) of words. A word is accepted that discloses by itself, or whose
    beginning and ending do and which is not seen to be plain."""
    words = counts.where("kind = 'word'").select("term", "n", "announced", (F.col("announced") / F.greatest("n", F.lit(1))).alias("share"))
    base = counts.where("kind = 'word'").agg((F.sum("announced") / F.sum("n")).alias("base")).scalar()
    words = words.withColumn("discloses", (F.col("announced") >= 1) & (F.col("share") >= SHARE) & (F.coalesce(F.try_divide(F.col("share"), base), F.lit(0.0)) >= LIFT))
    start, end, pair = F.lower(F.substring("term", 1, AFFIX)), F.expr(f"right(term, {AFFIX})"), F.expr(f"right(term, {AFFIX - 1})")
    sides = [F.struct(F.lit(side).alias("side"), key.alias("key")) for side, key in (("start", start), ("end", end), ("pair", pair))]
    affixes = words.where(F.length("term") > AFFIX).select("discloses", F.explode(F.array(*sides)).alias("a"))
    kept = affixes.groupBy("a.side", "a.key").agg(F.sum(F.col("discloses").cast("int")).alias("yes"), F.count(F.lit(1)).alias("all"))
    much = lambda of_pair, else_: F.when(F.col("side") == "pair", of_pair).otherwise(else_)
    kept = checkpointed(kept.where((F.col("yes") >= much(PAIR_WORDS, AFFIX_WORDS)) & (F.col("yes") >= F.col("all") * much(PAIR_SHARE, AFFIX_SHARE))).select("side", "key"))
    # Words are of the 26 letters, so there are at most 26 ** AFFIX keys to a side.
    side = lambda name: F.broadcast(kept.where(F.col("side") == name).select(F.col("key").alias(f"_{name}"), F.lit(True).alias(f"is_{name}")))
    met = words.join(side("start"), start == F.col("_start"), "left").join(side("end"), end == F.col("_end"), "left").join(side("pair"), pair == F.col("_pair"), "left")
    alike = (F.length("term") > AFFIX) & F.coalesce("is_start", F.lit(False)) & F.coalesce("is_end", "is_pair", F.lit(False))
    plain = (F.col("n") >= PLAIN_SUPPORT) & (F.col("share") < PLAIN_SHARE)
    return met.select("term", "n", ((F.col("discloses") & (F.col("n") >= SUPPORT)) | (alike & ~plain)).alias("accepted"))


def disclosing(documents: DataFrame, text: str = "text") -> tuple[DataFrame, frozenset[str]]:
    """((ask) of every accepted term, the SKIPPED most frequent words that are none)."""
    counts = checkpointed(disclosure(documents, text))
    words = checkpointed(word_terms(counts))
    sites = counts.where("kind in ('site', 'town')").groupBy("kind", "term").agg(F.sum("announced").alias("announced")).where(F.col("announced") >= SUPPORT)
    towns = sites.where("kind = 'town'").select(F.col("term").alias("one"), F.lit(True).alias("is_town"))
    # A street's word and a unit stand in a protected place before a town that has a postcode.
    parts = counts.where("kind in ('street', 'unit')").join(towns, "one", "left").groupBy("kind", "term").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("is_town"), F.col("n")).otherwise(0)).alias("announced"))
    few = sites.select("kind", "term").unionByName(parts.where((F.col("announced") >= SUPPORT) & (F.col("announced") >= F.col("n") * SHARE)).select("kind", "term"))
    asks = words.where("accepted").select(F.concat(F.lit("word:"), "term").alias("ask")).unionByName(number_terms(counts)).unionByName(few.select(F.concat_ws(":", "kind", "term").alias("ask")))
    skipped = words.where("not accepted").orderBy(F.desc("n"), "term").limit(SKIPPED).select("term").collect()
    return checkpointed(asks), frozenset(r["term"] for r in skipped)


_INNER = re.compile(r" (?:[A-Z]\. )*|-|, ")


def _lead(text: str, start: int) -> tuple[int, bool]:
    """Where the initials before a name begin, and whether a title stands before them."""
    at = start
    while at >= 3 and text[at - 1] == " " and text[at - 2] == "." and "A" <= text[at - 3] <= "Z" and (at == 3 or not (text[at - 4].isalnum() or text[at - 4] in "_.") ):
        at -= 3
    end = at - 1 if at and text[at - 1] == " " else at
    if end == at:
        return at, False
    end -= end > 0 and text[end - 1] == "."
    begin = end
    while begin > 0 and text[begin - 1].isalpha() and text[begin - 1].isascii():
        begin -= 1
    return at, text[begin:end] in TITLES and (begin == 0 or not (text[begin - 1].isalnum() or text[begin - 1] == "_"))


def cut(text: str, skipped: Callable[[str], bool]) -> dict[str, list]:
    """Candidates of a text: numbers, mail, addresses and words not ``skipped``, each with the
    text it is made of and all that putting details together needs, so that the text is not
    read again."""
    found: dict[str, list] = {"numbers": [], "mails": [[a, text[a:b]] for a, b in mails(text)], "addresses": [], "words": []}
    for kind, a, b in numbers(text):
        found["numbers"].append([kind, a, text[a:b], shape_of(text[a:b]), *before(text, a)])
    for m in addresses(text):
        g = next(g for g in "acdb" if m[f"s{g}"])
        street, begin = m[f"s{g}"], m.start(f"s{g}")
        city = m[f"c{g}"] if g != "d" else None
        ends, last = [], begin + len(street)
        # The name may go on after the street's word; then the address ends with that word.
        words = street.split(" ")
        for k in range(1, len(words) - 1) if g == "a" else ():
            ends.append([words[k].lower(), begin + len(" ".join(words[: k + 1])), "", 0])
        end, site, shorter = m.end(), "", 0
        if city and " " in city and not m[f"z{g}"] and not _STOPPED.match(text, m.end(f"c{g}")):
            site, shorter = city.rpartition(" ")[2].lower(), m.start(f"c{g}") + city.rindex(" ")
        ends.append([words[-1].lower(), end, site, shorter])
        unit = m["ua"] or m["ub"] or ""
        found["addresses"].append([m.start(), text[m.start() : max(end, last)], unit, _town(m, g), ends])
    rare = {w for w in set(_RUN.findall(text)) if len(w) > 1 and w.isalpha() and not skipped(w)}
    if rare:
        at = -1
        for m in _RUN.finditer(text):
            if m.group() in rare:
                gap = text[at : m.start()] if at >= 0 else "\n"
                lead, titled = _lead(text, m.start())
                found["words"].append([m.start(), m.group(), gap if _INNER.fullmatch(gap) else None, text[lead : m.start()], titled])
                at = m.end()
    return found


def asked(found: dict[str, list]) -> list[str]:
    """The terms that decide over the candidates of a text."""
    asks = {f"word:{_term(w[1])}" for w in found["words"]}
    for kind, _, _, shape, one, two in found["numbers"]:
        asks |= {f"shape:{kind}:{shape}", f"before:{kind}:{one}", f"before:{kind}:{two}", f"plain:{kind}:{two}"}
    for _, _, unit, town, ends in found["addresses"]:
        asks.add(f"town:{town}")
        asks |= {f"street:{e[0]}" for e in ends} | {f"site:{e[2]}" for e in ends if e[2]}
        if unit:
            asks.add(f"unit:{unit.partition(' ')[0]}")
    return sorted(asks)


def _people(words: list, known: frozenset[str] | set[str], taken: list[tuple[int, int]]) -> Iterator[tuple[int, str]]:
    """(start, text) of runs of disclosing words that are names: two and more, or one with
    initials or a title."""
    k = 0
    while k < len(words):
        start, first, _, lead, titled = words[k]
        if f"word:{_term(first)}" not in known:
            k += 1
            continue
        name, count, initials = first, 1, False
        while k + count < len(words):
            _, after, gap, _, _ = words[k + count]
            if gap is None or f"word:{_term(after)}" not in known or after.islower() != first.islower():
                break
            # A surname in capitals comes first and takes one given name after its comma.
            if gap == ", " and not (first.isupper() and count == 1 and not after.isupper()):
                break
            if gap != ", " and first.isupper() != after.isupper():
                break
            initials |= "." in gap
            name += gap + after
            count += 1
            if gap == ", ":
                break
        # The last letter of an identity number before a stop is no initial.
        if lead and not any(a < start and start - len(lead) < b for a, b in taken):
            start, name, initials = start - len(lead), lead + name, True
        if (count > 1 or initials or titled) and not any(a < start + len(name) and start < b for a, b in taken):
            yield start, name
        k += count


def put_together(found: dict[str, list], known: frozenset[str] | set[str]) -> list[tuple[str, int, str]]:
    """(type, start, text) of the details among candidates, in order and without overlap."""
    details: list[tuple[str, int, str]] = []
    taken: list[tuple[int, int]] = []

    def take(kind: str, start: int, text: str) -> None:
        if not any(a < start + len(text) and start < b for a, b in taken):
            details.append((kind, start, text))
            taken.append((start, start + len(text)))

    for start, text in found["mails"]:
        take("email", start, text)
    for kind in ("id", "phone"):
        for k, start, text, shape, one, two in found["numbers"]:
            said = f"before:{k}:{two}" in known or (f"before:{k}:{one}" in known and f"plain:{k}:{two}" not in known)
            if k == kind and (said or f"shape:{k}:{shape}" in known):
                take("id_number" if k == "id" else k, start, text)
    for start, text, unit, town, ends in found["addresses"]:
        # The town may speak for a street's word that is too rare to disclose by itself.
        chosen = ends[-1] if f"town:{town}" in known else next((e for e in reversed(ends) if f"street:{e[0]}" in known), None)
        if chosen:
            _, end, site, shorter = chosen
            end = shorter if site and f"site:{site}" not in known else end
            skip = len(unit) if unit and f"unit:{unit.partition(' ')[0]}" not in known else 0
            take("address", start + skip, text[skip : end - start])
    for start, text in _people(found["words"], known, taken):
        take("person", start, text)
    return sorted(details, key=lambda d: d[1])


def find_details(text: str | None, known: frozenset[str] | set[str]) -> list[tuple[str, int, str]]:
    """(type, start, text) of the details of one text by the ``ask`` terms that disclose."""
    return put_together(cut(text, lambda w: False), known) if text else []


def _details(documents: DataFrame, keys: list[Column], text: str, corpus: DataFrame) -> DataFrame:
    """(key, details) of the texts that have any. ``keys``: a number or name to tell back.

    Candidates are cut once and written. Their terms meet the disclosing ones in a join, are
    gathered by text, and decide.
    """
    asks, skip = disclosing(corpus, text)

    def cut_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo: dict[str, bool] = {}

        def skipped(word: str) -> bool:
            if word not in memo:
                if len(memo) > 1 << 18:
                    memo.clear()
                memo[word] = _term(word) in skip
            return memo[word]

        for batch in batches:
            rows = []
            for key, t in zip(batch["key"], batch["t"]):
                found = cut(t, skipped)
                if any(found.values()):
                    digest = hashlib.sha256(t.encode(errors="surrogatepass")).hexdigest()
                    rows.append((key, digest, json.dumps(found), asked(found)))
            yield pd.DataFrame(rows, columns=["key", "text_id", "found", "asks"])

    slim = documents.select(keys[0].alias("key"), F.col(text).alias("t")).where("t is not null and t <> ''")
    pieces = checkpointed(slim.mapInPandas(cut_all, "key long, text_id string, found string, asks array<string>"))
    # Equal texts have equal details: their terms are looked up once.
    once = pieces.groupBy("text_id").agg(F.first("found").alias("found"), F.first("asks").alias("asks"))
    known = pieces.select("text_id", F.explode("asks").alias("ask")).join(broadcast_if_small(asks), "ask").groupBy("text_id").agg(F.collect_set("ask").alias("known"))  # a text's own terms

    def decide(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text_id, found, terms in zip(batch["text_id"], batch["found"], batch["known"]):
                details = put_together(json.loads(found), set() if terms is None else set(terms))
                if details:
                    rows.append((text_id, [{"pii_type": k, "start": a, "value_text": v} for k, a, v in details]))
            yield pd.DataFrame(rows, columns=["text_id", "details"])

    decided = once.select("text_id", "found").join(known, "text_id", "left").mapInPandas(decide, f"text_id string, details {_DETAILS}")
    return pieces.select("key", "text_id").join(decided, "text_id")


_DETAILS = "array<struct<pii_type: string, start: int, value_text: string>>"


def personal_details(documents: DataFrame, *, doc_id: str = "doc_id", text: str = "text", corpus: DataFrame | None = None) -> DataFrame:
    """(doc_id, pii_type, value_text): a row per distinct detail of a document.

    Null and empty texts have no details; whole texts are read. Repeated ids give the
    details of all their texts. An empty table gives no rows. Other columns are ignored.
    ``corpus`` are the texts that terms are counted in, ``documents`` unless given.
    """
    found = _details(documents.where(F.col(doc_id).isNotNull()), [F.col(doc_id).cast("long")], text, documents if corpus is None else corpus)
    return found.select(F.col("key").alias(doc_id), F.explode("details").alias("d")).select(doc_id, "d.pii_type", "d.value_text").distinct()


def redact(documents: DataFrame, *, text: str = "text", corpus: DataFrame | None = None) -> DataFrame:
    """``documents`` with each detail in ``text`` replaced by its type in brackets.

    All else, other columns included, is unchanged; null texts stay null.
    """
    found = _details(documents, [F.lit(0).cast("long")], text, documents if corpus is None else corpus).select("text_id", "details").dropDuplicates(["text_id"])

    @F.pandas_udf("string")
    def clean(texts: pd.Series, details: pd.Series) -> pd.Series:
        return pd.Series([t if d is None else _stamped(t, [(x["pii_type"], x["start"], x["value_text"]) for x in d]) for t, d in zip(texts, details)], dtype=object)

    keyed = documents.withColumn("_text_id", F.sha2(F.col(text), 256))
    both = keyed.join(found.withColumnRenamed("details", "_details"), F.col("_text_id") == F.col("text_id"), "left")
    return both.withColumn(text, clean(F.col(text), F.col("_details"))).select(*documents.columns)


def _stamped(text: str, details: list[tuple[str, int, str]]) -> str:
    out, at = [], 0
    for kind, start, value in details:
        out += [text[at:start], f"[{kind.upper()}]"]
        at = start + len(value)
    return "".join([*out, text[at:]])


def replaced(text: str | None, known: frozenset[str] | set[str]) -> str | None:
    """One text with placeholders."""
    return _stamped(text, find_details(text, known)) if text else text
