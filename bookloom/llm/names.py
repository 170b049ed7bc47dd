"""Linking variant spellings of names and titles typed by people.

Bylines are parsed into the tokens of the first-named author.  Distinct bags of
tokens are joined by a prefix-filtered set-similarity join on the q-grams of
their tokens: only the heaviest tokens of a bag, without which the threshold
cannot be reached, are looked up, by their rarest q-grams.  Candidates are
verified by a soft weighted similarity of the tokens, where a token weighs more
the fewer different partners it has.  A token shared by many rows of one person
has few partners, so dominant names stay heavy.
"""

from __future__ import annotations

import difflib
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bookloom.operators.graph import components
from bookloom.operators.skew import split_join
from bookloom.session import materialize

#: Least soft weighted similarity of two bylines.
THRESHOLD = 0.68
#: Least similarity of two bylines that share a title.
NEAR = 0.5
#: By the edits that two tokens may differ by: least and greatest length of a token, and the length of its q-grams.
CLASSES = {1: (4, 8, 3), 2: (8, 10**9, 4)}
#: Least similarity of two titles, character by character.
TITLE = 0.86

# Short forms of given names and the names they stand for.
NICKNAMES = {
    "alex": "alexander", "sasha": "alexander", "sandy": "alexander", "tonda": "antonin", "tonik": "antonin", "toni": "antonin", "tony": "antonin anthony", "ben": "benedikt benjamin", "benda": "benedikt", "benny": "benedikt benjamin",
    "charlie": "charles", "chuck": "charles", "karel": "charles", "dora": "dorothea", "thea": "dorothea", "dorka": "dorothea", "dolly": "dorothea", "dot": "dorothea", "ed": "edward", "eddie": "edward", "ned": "edward", "ted": "edward theodore", "teddy": "edward theodore",
    "liz": "elizabeth", "betty": "elizabeth", "beth": "elizabeth", "eliza": "elizabeth", "lizzie": "elizabeth", "bess": "elizabeth", "franta": "frantisek", "fanda": "frantisek", "fana": "frantisek", "frank": "frantisek francis", "fritz": "friedrich", "fred": "friedrich frederick",
    "freddy": "friedrich frederick", "gabe": "gabriel", "gabor": "gabriel", "gaby": "gabriel", "harry": "heinrich henry harold", "heinz": "heinrich", "heiner": "heinrich", "hank": "henry heinrich", "honza": "jan", "jenda": "jan", "jack": "john jan", "jura": "jiri", "jirka": "jiri",
    "george": "jiri", "hanna": "johanna", "jana": "johanna", "hanka": "johanna", "hanne": "johanna", "jo": "johanna josef", "pepa": "josef", "jozka": "josef", "joe": "josef joseph", "sepp": "josef", "kate": "katherine", "kathy": "katherine", "katie": "katherine", "kitty": "katherine", "kat": "katherine",
    "lida": "ludmila", "mila": "ludmila", "lidka": "ludmila", "magda": "magdalena", "lena": "magdalena", "madla": "magdalena", "meg": "margaret", "peggy": "margaret", "maggie": "margaret", "greta": "margaret", "madge": "margaret", "nick": "nicholas", "nico": "nicholas", "klaus": "nicholas",
    "ottla": "ottilie", "tilly": "ottilie", "tilda": "ottilie", "otti": "ottilie", "pat": "patricia patrick", "tricia": "patricia", "patty": "patricia", "trish": "patricia", "dick": "richard", "rick": "richard", "rich": "richard", "ricky": "richard", "bob": "robert", "rob": "robert", "bobby": "robert", "bert": "robert",
    "robin": "robert", "rosa": "rosalind", "lindy": "rosalind", "roz": "rosalind", "rose": "rosalind", "sam": "samuel", "sammy": "samuel", "theo": "theodore", "vasek": "vaclav", "venca": "vaclav", "vena": "vaclav", "will": "william", "bill": "william", "billy": "william", "liam": "william", "willy": "william", "zach": "zacharias",
    "zack": "zacharias", "zachy": "zacharias", "zac": "zacharias",
}
#: Given names and their short forms, which are taken for frequent before any row is seen.
GIVEN = sorted({*NICKNAMES, *(n for v in NICKNAMES.values() for n in v.split())})
#: Tokens, and partners of a given name, supposed beforehand, so that few rows are weighed like many.
TOKENS_BEFORE, GIVEN_BEFORE = 1000, 50
# Kinds of organisation and their short forms.
TYPES = {"institute": "institute", "inst": "institute", "society": "society", "soc": "society", "academy": "academy", "acad": "academy", "foundation": "foundation", "fdn": "foundation", "found": "foundation", "seminar": "seminar", "sem": "seminar", "university": "university", "univ": "university", "college": "college", "coll": "college", "circle": "circle", "press": "press", "association": "association", "assoc": "association", "centre": "centre", "center": "centre"}
# What sets a person apart from a namesake.
JUNIOR = {"younger", "junior", "jr", "jun", "ml", "mladsi", "filius"}
SENIOR = {"elder", "senior", "sr", "sen", "st", "starsi", "pater"}

_MOJIBAKE = re.compile(r"[ÃÅÄÂâÆ][\x80-\xbf€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ¡-¿\-]")
_TITLES = re.compile(r"\b(?:dr|prof|phd|ph\.\s?d|mgr|ing|doc|sir|csc|drsc)\b\.?", re.I)
_EDITORS = re.compile(r"\(\s*(?:eds?|trans|překl|hrsg)\.?\s*\)|\bet\s+al\b\.?|\ba\s+kol\b\.?|\bu\.\s?a\.", re.I)
_SPLIT = re.compile(r"\s*(?:;|&|\+|/)\s*|\s+(?:and|und|et|y)\s+", re.I)
_A = re.compile(r"\s+a\s+")
_ACRONYM = re.compile(r"^([A-Z])(?:f|o)?([A-Z])(S)$")
_ORG = re.compile(r"\b(?:institute|inst\.|society|soc\.|academy|acad\.|foundation|fdn\.|seminar|sem\.|university|univ\.|college|association|assoc\.|studies|stud\.)(?!\w)|\b[A-Z]f[A-Z]S\b", re.I)


def mended(text: str) -> str:
    """A text that was read in the wrong code page, read in the right one; other texts stay."""
    if not _MOJIBAKE.search(text):
        return text
    raw = bytearray()
    for c in re.sub(r"Ã-", "Ã\xad", text):
        try:
            raw += c.encode("cp1252")
        except UnicodeEncodeError:
            if ord(c) > 255:
                return text
            raw.append(ord(c))
    try:
        return raw.decode("utf-8")
    except UnicodeDecodeError:
        return text


def flat(text: str) -> str:
    """Lower case without marks."""
    return "".join(c for c in unicodedata.normalize("NFKD", text.lower()) if not unicodedata.combining(c)).replace("ł", "l").replace("ß", "ss").replace("ø", "o")


def parse_author(text: str | None) -> tuple[str, list[str], list[str], str, str]:
    """(kind, tokens, initials, suffix, extra) of the first-named author.

    kind: ``person``, ``org`` or empty for a byline without letters.  For an
    organisation the tokens are its name, ``extra`` is ``type|subject`` (an
    acronym gives their initials).
    """
    s = re.sub(r"\s+", " ", mended(text or "").replace("_", " ")).strip(" \"'“”„.")
    if not any(c.isalpha() for c in s):
        return "", [], [], "", ""
    s = _EDITORS.sub(" ", s)
    if _ORG.search(s):
        first = re.split(r"\s*[;&]\s*", s)[0]
        return _parse_org(first)
    s = _TITLES.sub(" ", s)
    s = re.sub(r"\([^)]*\)", " ", s)
    first = next((p for p in _SPLIT.split(s) if any(c.isalpha() for c in p)), s)
    pieces = _A.split(first.lower() if first.isupper() else first)
    if len(pieces) > 1 and len(re.findall(r"\w+", pieces[0])) >= 2:
        first = first[: len(pieces[0])]
    shout = first.isupper()
    tokens, initials, suffix = [], [], ""
    for raw in re.findall(r"[^\W\d_](?:[^\W\d_]|['’\-](?=[^\W\d_]))*\.?", first):
        w = flat(raw.rstrip(".")).replace("-", "").replace("'", "").replace("’", "")
        if w in JUNIOR or w in SENIOR:
            suffix = "jr" if w in JUNIOR else "sr"
        elif w in ("the", "von", "van", "de", "da", "der", "del", "di", "la", "le"):
            continue
        elif len(w) == 1:
            initials.append(w)
        elif raw.isupper() and not shout and (len(w) == 2 or len(w) == 3 and not re.search(r"[AEIOUYÁÉÍÓÚ]", raw[1:])):
            initials += list(w)
        elif raw.endswith(".") and len(w) <= 4:
            tokens.append(w + ".")
        elif w:
            tokens.append(w)
    if len(tokens) == 1 and tokens[0].endswith(".") and not initials:
        tokens = [tokens[0][:-1]]
    return "person", sorted(set(tokens)), sorted(set(initials)), suffix, ""


def _parse_org(text: str) -> tuple[str, list[str], list[str], str, str]:
    kind = subject = ""
    names, after = [], False
    for raw in re.findall(r"[^\W\d_]+\.?", text):
        w = flat(raw.rstrip("."))
        if (m := _ACRONYM.match(raw)) and not text.isupper():
            kind, subject = m[1].lower(), m[2].lower()
        elif w in ("the", "studies", "stud"):
            after = False if w != "the" else after
        elif w in ("for", "of", "f"):
            after = True
        elif w in TYPES and not kind:
            kind = TYPES[w]
        elif after and not subject:
            subject = w
        elif len(w) > 1:
            names.append(w)
    return "org", sorted(set(names)) or [subject or kind], [], "", f"{kind}|{subject}"


def osa(a: str, b: str, most: int) -> int:
    """Edits, with swaps of neighbours, between two words; ``most + 1`` once there are more."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    two, one = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            d = min(one[j] + 1, row[j - 1] + 1, one[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, two[j - 2] + 1)
            row.append(d)
        if min(row) > most:
            return most + 1
        two, one = one, row
    return min(one[-1], most + 1)


def allowed(a: str, b: str) -> int:
    """How many edits two tokens may differ by: none up to three letters, one up to seven, two beyond."""
    n = min(len(a), len(b))
    return 0 if n <= 3 else 1 if n <= 7 else 2


def alike(a: str, b: str) -> float:
    """Similarity of two tokens: equal 1, a nickname or an abbreviation 0.95, else by edits; 0 when too far apart."""
    if a == b:
        return 1.0
    for x, y in ((a, b), (b, a)):
        if x.endswith(".") and y.startswith(x[:-1]):
            return 0.95
        if y in NICKNAMES.get(x, "").split():
            return 0.95
    if set(NICKNAMES.get(a, "").split()) & set(NICKNAMES.get(b, "").split()):
        return 0.9
    most = allowed(a, b)
    d = osa(a, b, most) if most else 1
    if d <= most:
        return 1 - d / max(len(a), len(b))
    near = [y for y in NICKNAMES.get(a, "").split() if osa(b, y, 1) <= 1] or [y for y in NICKNAMES.get(b, "").split() if osa(a, y, 1) <= 1]
    return 0.8 if near else 0.0


def soft_similarity(a: dict, b: dict) -> tuple[float, bool]:
    """(similarity, full): matched weight over all weight of two bags; full when more than a surname and initials agree.

    Tokens are matched greedily, the most alike first; a matched pair counts
    with the lesser weight.  Initials match the first letter of a token or an
    equal initial.  A conflict of kind, suffix, type or subject gives 0.
    """
    if a["kind"] != b["kind"] or a["suffix"] != b["suffix"]:
        return 0.0, False
    if a["kind"] == "org":
        for x, y in zip(a["extra"].split("|"), b["extra"].split("|")):
            if x and y and not alike(x, y) and not (min(len(x), len(y)) == 1 and x[0] == y[0]):
                return 0.0, False
        best = max((alike(x, y) for x in a["tokens"] for y in b["tokens"]), default=0.0)
        return best, best > 0
    wa, wb = dict(zip(a["tokens"], a["weights"])), dict(zip(b["tokens"], b["weights"]))
    pairs = sorted(((alike(x, y), min(wa[x], wb[y]), x, y) for x in wa for y in wb), key=lambda p: (-p[0], -p[1], p[2], p[3]))
    matched, total, used_a, used_b, named = 0.0, 0.0, set(), set(), 0
    for s, w, x, y in pairs:
        if s > 0 and x not in used_a and y not in used_b:
            used_a.add(x)
            used_b.add(y)
            matched += s * w
            total += w
            named += 1
    rest_a, rest_b = [t for t in wa if t not in used_a], [t for t in wb if t not in used_b]
    if not used_a:
        return 0.0, False
    low = min([*wa.values(), *wb.values()])
    ini_a, ini_b = list(a["initials"]), list(b["initials"])
    clash = False
    for inits, rest, weights in ((ini_a, rest_b, wb), (ini_b, rest_a, wa)):
        for i in list(inits):
            hit = next((t for t in rest if t[0] == i or any(n[0] == i for n in NICKNAMES.get(t, "").split())), None)
            if hit:
                rest.remove(hit)
                inits.remove(i)
                w = min(weights[hit], low * 1.5)
                matched += 0.9 * w
                total += w
    for i in list(ini_a):
        if i in ini_b:
            ini_a.remove(i)
            ini_b.remove(i)
            matched += 0.9 * low
            total += low
    if (ini_a or rest_a) and (ini_b or rest_b):
        clash = True
    total += sum(wa[t] for t in rest_a) + sum(wb[t] for t in rest_b) + 0.5 * low * (len(ini_a) + len(ini_b))
    if clash:  # each has a name the other lacks
        total += low
    return matched / total if total else 0.0, named >= 2


_ARTICLES = {"the", "a", "an", "der", "die", "das", "le", "la", "les"}
_PART = re.compile(r"[,:\s(]*\b(?:part|pt|vol|volume|díl|dil|teil|tome|book|svazek|band)\b\.?\s*(\d+|[ivx]+)\b\)?", re.I)


def parse_title(text: str | None) -> tuple[str, str, str, bool]:
    """(main, subtitle, part, truncated): words without articles, edition notes and quotes."""
    s = re.sub(r"\s+", " ", mended(text or "").replace("_", " ")).strip(" \"'“”„")
    cut = bool(re.search(r"(…|\.\.\.)$", s))
    s = re.sub(r"(…|\.\.\.)$", "", s)
    part = ""
    if m := _PART.search(s):
        part = m[1].lower()
        part = {"i": "1", "ii": "2", "iii": "3", "iv": "4", "v": "5", "vi": "6"}.get(part, part)
        s = s[: m.start()] + " " + s[m.end() :]
    s = re.sub(r"\([^)]*\)|\[[^\]]*\]", " ", s)
    s = re.sub(r",\s*(?:the|a|an)\s*$", "", s, flags=re.I)
    s = re.sub(r"\bintro\.", "introduction", s, flags=re.I)
    main, *sub = re.split(r"\s*:\s*|\s+[-–—]\s+", s, maxsplit=1)
    words = lambda x: " ".join(w for w in re.findall(r"[^\W_]+", flat(x.replace("&", " and "))) if w not in _ARTICLES)
    return words(main), words(sub[0]) if sub else "", part, cut


def title_words(main: Column) -> Column:
    """What titles that mean one work have in common: words, two neighbours as one (parted in one title only), the first letters (cut titles)."""
    words = F.split(main, " ")
    joined = F.zip_with(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))), lambda a, b: F.concat(a, b))
    first = F.concat(F.lit("^"), F.substring(F.replace(main, F.lit(" ")), 1, 4))
    return F.when(main != "", F.array_distinct(F.filter(F.concat(words, joined, F.array(first)), lambda w: w != ""))).otherwise(F.array().cast("array<string>"))


def _ratio(a: str, b: str) -> float:
    return difflib.SequenceMatcher(None, a, b, autojunk=False).ratio() if a and b else float(a == b)


def same_title(a: dict, b: dict) -> tuple[bool, bool]:
    """(alike, sure): whether two titles may mean one work; not sure where a cut title hides the part."""
    if a["part"] != b["part"] and not (a["cut"] and not a["part"]) and not (b["cut"] and not b["part"]):
        return False, False
    sure = a["part"] == b["part"]
    full_a, full_b = f"{a['main']} {a['sub']}".strip(), f"{b['main']} {b['sub']}".strip()
    if not full_a or not full_b:
        return False, False
    if a["cut"] or b["cut"]:
        n = min(len(x["main"] + x["sub"]) + bool(x["sub"]) for x in (a, b) if x["cut"])
        n = min(n, len(full_a), len(full_b))
        return n >= 6 and _ratio(full_a[:n], full_b[:n]) >= TITLE, sure
    if _ratio(full_a, full_b) >= TITLE and _words_agree(full_a, full_b):
        return True, sure
    if bool(a["sub"]) != bool(b["sub"]):
        return _ratio(a["main"], b["main"]) >= TITLE and _words_agree(a["main"], b["main"]), sure
    return False, False


def _words_agree(a: str, b: str) -> bool:
    """Whether every word of the one has a word alike in the other; joined or parted words are let pass."""
    x, y = a.split(), b.split()
    if abs(len(x) - len(y)) > 1:
        return False
    if len(x) != len(y):
        return _ratio(a.replace(" ", ""), b.replace(" ", "")) >= 0.93
    return all(p == q or p.startswith(q) and len(q) >= 4 or q.startswith(p) and len(p) >= 4 or osa(p, q, 2) <= (1 if min(len(p), len(q)) <= 4 else 2) for p, q in zip(x, y))


PARSED = "id string, kind string, tokens array<string>, initials array<string>, suffix string, extra string, bag string, main string, sub string, part string, cut boolean, work string"


def parsed_rows(responses: DataFrame) -> DataFrame:
    """One row per id: the parsed byline and title.  Of several rows with one id the greatest (author, title) counts; null ids are dropped."""
    rows = responses.where("id IS NOT NULL").groupBy("id").agg(F.max(F.struct("classified_at", "author", "title")).alias("r")).select("id", "r.author", "r.title")

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for i, author, title in zip(pdf["id"], pdf["author"], pdf["title"]):
                kind, tokens, initials, suffix, extra = parse_author(author)
                main, sub, part, cut = parse_title(title)
                out.append((i, kind, tokens, initials, suffix, extra, "|".join((kind, *tokens, "/", *initials, suffix, extra)), main, sub, part, cut, f"{main}|{sub}|{part}|{cut}"))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in PARSED.split(", ")])

    return rows.mapInPandas(parse, PARSED)


def _spread(df: DataFrame) -> DataFrame:
    """``df`` over all tasks: a few bytes of pairs can be much work for Python."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _grams(token: str, q: int) -> list[tuple[str, int]]:
    """(gram, place) of a token; grams that occur again are numbered, so that a token of n letters has n + q - 1."""
    padded = "^" * (q - 1) + token + "$" * (q - 1)
    seen: dict[str, int] = {}
    out = []
    for i in range(len(padded) - q + 1):
        g = padded[i : i + q]
        seen[g] = k = seen.get(g, 0) + 1
        out.append((g if k == 1 else f"{g}{k}", i))
    return out


def gram_pairs(heads: DataFrame, tokens: DataFrame) -> DataFrame:
    """(head, token): pairs of different tokens whose q-grams do not rule out the allowed edits.

    One edit, or a swap of neighbours, touches at most q + 1 grams, so two tokens
    within d edits share one of the d (q + 1) + 1 rarest grams of each; it stands
    at most d places apart, and the lengths differ by at most d.
    """

    def grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for t in pdf["token"]:
                for edits, (least, most, q) in CLASSES.items():
                    if least <= len(t) <= most:
                        out += [(t, edits, g, i, len(t)) for g, i in _grams(t, q)]
            yield pd.DataFrame(out, columns=["token", "edits", "gram", "place", "size"])

    every = materialize(_spread(tokens.select("token").distinct()).mapInPandas(grams, "token string, edits int, gram string, place int, size int"), "grams")
    counts = every.groupBy("edits", "gram").agg(F.count(F.lit(1)).alias("df"))
    order = Window.partitionBy("token", "edits").orderBy("df", "gram")
    length = F.when(F.col("edits") == 1, CLASSES[1][2]).otherwise(CLASSES[2][2])
    first = every.join(counts, ["edits", "gram"]).withColumn("k", F.row_number().over(order)).where(F.col("k") <= F.col("edits") * (length + 1) + 1).drop("df", "k")
    first = materialize(first, "prefixes")
    left = first.join(heads.select("token").distinct(), "token", "left_semi").select(F.col("token").alias("head"), "edits", "gram", F.col("place").alias("at"), F.explode(F.sequence(F.col("size") - F.col("edits"), F.col("size") + F.col("edits"))).alias("size"))
    n, key = int(heads.sparkSession.conf.get("spark.sql.shuffle.partitions")), ["edits", "gram", "size"]
    pairs = left.repartition(n, *key).join(first.repartition(n, *key), key).where((F.col("head") != F.col("token")) & (F.abs(F.col("at") - F.col("place")) <= F.col("edits")))
    # a swap is two edits to levenshtein, which needs no Python and leaves few pairs
    return pairs.where(F.levenshtein("head", "token") <= 2 * F.col("edits")).select("head", "token").distinct()


def similar_tokens(heads: DataFrame, tokens: DataFrame) -> DataFrame:
    """(head, token): every token within the allowed edits of a head, itself included."""

    def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf[[osa(a, b, allowed(a, b)) <= allowed(a, b) for a, b in zip(pdf["head"], pdf["token"])]]

    same = heads.select(F.col("token").alias("head"), "token").distinct()
    return _spread(gram_pairs(heads, tokens)).mapInPandas(near, "head string, token string").unionByName(same)


def byline_links(bags: DataFrame) -> DataFrame:
    """(a, b, similarity, full) of all pairs of bags of at least ``NEAR``, complete from ``THRESHOLD`` on; bags: bag, kind, tokens, initials, suffix, extra."""
    each = bags.select("bag", F.explode("tokens").alias("token"))
    mates = bags.select(F.explode("tokens").alias("token"), "tokens", "initials").select("token", F.explode_outer(F.array_except("tokens", F.array("token"))).alias("mate")).distinct()
    partners = mates.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    total = partners.agg(F.count(F.lit(1)).alias("all"))
    given = F.col("token").isin(GIVEN) | F.col("token").endswith(".")
    rarity = F.log1p((F.col("all") + TOKENS_BEFORE) / (F.col("df") + F.when(given, GIVEN_BEFORE).otherwise(0)))
    weights = materialize(partners.join(F.broadcast(total)).select("token", rarity.alias("weight")), "weights")
    weighted = each.join(weights, "token")
    per_bag = weighted.groupBy("bag").agg(F.sort_array(F.collect_list(F.struct("token", "weight"))).alias("tw"))
    full = materialize(bags.drop("tokens").join(per_bag, "bag").select("bag", "kind", "initials", "suffix", "extra", F.col("tw.token").alias("tokens"), F.col("tw.weight").alias("weights")), "bags")
    heavy = Window.partitionBy("bag").orderBy(F.col("weight").desc(), "token").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy("bag")
    ranked = weighted.withColumn("before", F.coalesce(F.sum("weight").over(heavy), F.lit(0.0))).withColumn("sum", F.sum("weight").over(everything))
    heads = materialize(ranked.where(F.col("before") <= (1 - THRESHOLD) * F.col("sum")).select("bag", "token"), "heads")
    links = similar_tokens(heads, weights)
    # a token that many bags hold is light and seldom looked up; the bags that hold it are split
    looked = materialize(heads.withColumnRenamed("token", "head").join(links, "head").select("bag", "token").distinct(), "looked")
    pairs = split_join(looked, each.withColumnRenamed("bag", "other"), ["token"]).where("bag != other")
    pairs = pairs.select(F.least("bag", "other").alias("a"), F.greatest("bag", "other").alias("b")).distinct()
    sides = [full.select(*[F.col(c).alias(f"{s}_{c}" if c != "bag" else s) for c in full.columns]) for s in "ab"]
    rows = pairs.join(sides[0], "a").join(sides[1], "b").where("a_kind = b_kind AND a_suffix = b_suffix")
    fields = ["kind", "initials", "suffix", "extra", "tokens", "weights"]

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for r in pdf.to_dict("records"):
                s, f = soft_similarity(*({c: r[f"{x}_{c}"] for c in fields} for x in "ab"))
                if s >= NEAR:
                    out.append((r["a"], r["b"], s, f))
            yield pd.DataFrame(out, columns=["a", "b", "similarity", "full"])

    return _spread(rows).mapInPandas(verify, "a string, b string, similarity double, full boolean")


def _labelled(nodes: DataFrame, edges: DataFrame, node: str) -> DataFrame:
    """``nodes`` with column ``label``: the smallest node each is tied to, itself without ties."""
    tied = components(edges).select(F.col("node").alias(node), "component")
    return nodes.join(tied, node, "left").withColumn("label", F.coalesce("component", node)).drop("component")


class Variants:
    """Rows of typed names with the person or organisation, and the work, each stands for."""

    def __init__(self, responses: DataFrame) -> None:
        self.parsed = materialize(parsed_rows(responses), "parsed")
        self.rows = rows = self.parsed.where("kind != ''")
        bags = rows.select("bag", "kind", "tokens", "initials", "suffix", "extra").distinct()
        links = materialize(byline_links(bags), "bylines")
        near = links.where(F.col("similarity") < THRESHOLD)
        #: (bag, title): the different titles of each byline.
        titles = rows.select("bag", F.struct("main", "sub", "part", "cut").alias("title")).distinct()
        # titles that mean one work have a word in common, so titles of two bylines meet by words
        words = materialize(titles.select("bag", "title", F.explode(title_words(F.col("title.main"))).alias("word")), "words")
        near = near.join(words.select(F.col("bag").alias("a"), F.col("title").alias("at"), "word"), "a")
        near = split_join(near, words.select(F.col("bag").alias("b"), F.col("title").alias("bt"), "word"), ["b", "word"]).drop("word").distinct()

        def agree(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                yield pdf.loc[[same_title(a, b) == (True, True) for a, b in zip(pdf["at"], pdf["bt"])], ["a", "b", "similarity", "full"]]

        near = near.select("a", "b", "similarity", "full", "at", "bt").mapInPandas(agree, "a string, b string, similarity double, full boolean").distinct()
        links = links.where(F.col("similarity") >= THRESHOLD).unionByName(near)
        # bylines with a given name stand for themselves, those with initials or a surname only lean on them
        named = bags.select("bag", ((F.size(F.filter("tokens", lambda t: ~t.endswith("."))) >= 2) | (F.col("kind") == "org")).alias("named"))
        ends = links.join(named.select(F.col("bag").alias("a"), F.col("named").alias("na")), "a").join(named.select(F.col("bag").alias("b"), F.col("named").alias("nb")), "b")
        ends = materialize(ends, "ends")
        strong = _labelled(named.where("named").select("bag"), ends.where("na AND nb AND full").select("a", "b"), "bag")
        strong = materialize(strong.select("bag", F.concat(F.lit("n:"), "label").alias("person")), "persons")
        lean = ends.where("na != nb").select(F.when(F.col("na"), F.col("b")).otherwise(F.col("a")).alias("weak"), F.when(F.col("na"), F.col("a")).otherwise(F.col("b")).alias("bag"))
        lean = materialize(lean.join(strong, "bag").select("weak", "person").distinct(), "leaning")
        weak_rows = rows.join(named.where("NOT named"), "bag").select("id", "bag", "main", "sub", "part", "cut")
        ways = lean.groupBy(F.col("weak").alias("bag")).agg(F.count(F.lit(1)).alias("ways"), F.first("person").alias("person"))
        only = weak_rows.join(ways.where("ways = 1").select("bag", "person"), "bag").select("id", "person")
        # several persons fit: the one with a work of that title is meant; titles meet by words, not by persons
        several = ways.where("ways > 1").select("bag")
        theirs = words.join(strong, "bag").select("person", F.col("title").alias("theirs"), "word").distinct()
        theirs = lean.join(several.select(F.col("bag").alias("weak")), "weak").join(theirs, "person").select(F.col("weak").alias("bag"), "person", "theirs", "word")
        theirs = materialize(theirs, "theirs")
        own = words.join(several, "bag").select("bag", F.col("title").alias("own"), "word")
        unsure = split_join(own, theirs, ["bag", "word"]).select("bag", "person", "own", "theirs").distinct()

        def fits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                yield pdf.loc[[same_title(a, b)[0] for a, b in zip(pdf["own"], pdf["theirs"])], ["bag", "own", "person"]]

        title = "struct<main: string, sub: string, part: string, cut: boolean>"
        fitting = _spread(unsure).mapInPandas(fits, f"bag string, own {title}, person string").distinct().groupBy("bag", "own").agg(F.count(F.lit(1)).alias("k"), F.first("person").alias("person")).where("k = 1")
        meant = weak_rows.withColumn("own", F.struct("main", "sub", "part", "cut")).join(fitting, ["bag", "own"]).select("id", "person")
        placed = materialize(rows.join(strong, "bag").select("id", "person").unionByName(only).unionByName(meant), "placed")
        rest = weak_rows.join(placed, "id", "left_anti").select("id", "bag")
        among = _labelled(rest.select("bag").distinct(), ends.where("NOT na AND NOT nb").select("a", "b"), "bag").select("bag", F.concat(F.lit("w:"), "label").alias("person"))
        #: (id, person)
        self.persons = materialize(placed.unionByName(rest.join(among, "bag").select("id", "person")), "people")
        self.works = materialize(self._works(), "works")

    def _works(self) -> DataFrame:
        """(id, person, work): the works of each person, titles that mean the same work under one label."""
        rows = self.rows.join(self.persons, "id").where("main != ''")
        titles = materialize(rows.select("person", "work", "main", "sub", "part", "cut").distinct(), "titles")
        words = materialize(titles.select("person", "work", "cut", F.length("main").alias("size"), F.explode(title_words(F.col("main"))).alias("token")), "words")
        df = words.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
        order = Window.partitionBy("person", "work").orderBy("df", "token")
        # of a title's n characters at most (1 - TITLE) n differ; so many of its rarest words and one more cannot all be spoilt
        first = words.join(df, "token").withColumn("k", F.row_number().over(order)).where(F.col("cut") | (F.col("k") <= (1 - TITLE) * F.col("size") + 1))
        alike = similar_tokens(first.select("token"), words.select("token"))
        looked = first.select("person", F.col("token").alias("head"), F.col("work").alias("x")).join(alike, "head").select("person", "token", "x").distinct()
        looked = materialize(looked, "looked")
        pairs = split_join(looked, words.select("person", "token", F.col("work").alias("y")), ["person", "token"]).where("x != y")
        pairs = pairs.select("person", F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()
        side = lambda s: titles.select("person", F.col("work").alias(s), F.struct("main", "sub", "part", "cut").alias(f"{s}t"))
        rows2 = pairs.join(side("x"), ["person", "x"]).join(side("y"), ["person", "y"])

        def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                out = []
                for p, x, y, a, b in zip(pdf["person"], pdf["x"], pdf["y"], pdf["xt"], pdf["yt"]):
                    ok, sure = same_title(a, b)
                    if ok:
                        out.append((p, x, y, sure, a["part"] or b["part"]))
                yield pd.DataFrame(out, columns=["person", "x", "y", "sure", "part"])

        same = materialize(_spread(rows2).mapInPandas(verify, "person string, x string, y string, sure boolean, part string"), "sametitle")
        sure = same.where("sure").select("person", "x", "y")
        # a cut title that hides its part belongs to a part only where there is just one
        hidden = same.where("NOT sure").select("person", F.when(F.col("x").endswith("||true"), F.col("x")).otherwise(F.col("y")).alias("x"), F.when(F.col("x").endswith("||true"), F.col("y")).otherwise(F.col("x")).alias("y"), "part")
        one = hidden.groupBy("person", "x").agg(F.countDistinct("part").alias("k"), F.min("y").alias("y")).where("k = 1")
        plainly = sure.select("person", "x").unionByName(sure.select("person", F.col("y").alias("x"))).distinct()
        free = one.join(plainly.where(F.col("x").endswith("||true")), ["person", "x"], "left_anti").select("person", "x", "y")
        key = lambda c: F.concat_ws("¦", "person", c)
        edges = sure.unionByName(free).select(key("x").alias("a"), key("y").alias("b"))
        tied = components(edges).select(F.col("node").alias("t"), "component")
        own = rows.select("id", "person", key("work").alias("t"))
        return own.join(tied, "t", "left").select("id", "person", F.coalesce("component", "t").alias("work"))

    def found(self) -> DataFrame:
        """(id_a, id_b, kind): every two rows of one author, and among them those of one work."""
        out = []
        for kind, table, key in (("author", self.persons, "person"), ("work", self.works, "work")):
            x, y = (table.select(F.col(key).alias("k"), F.col("id").alias(f"id_{s}")) for s in "ab")
            out.append(x.join(y, "k").where("id_a < id_b").select("id_a", "id_b", F.lit(kind).alias("kind")))
        return out[0].unionByName(out[1]).distinct()

    def classes(self) -> DataFrame:
        """(id, person, work, links): the class of every row and the number of other rows in its person's class.

        A row whose byline is null or has no letter is a class of its own, with
        its id as person; the work is null where the title is.
        """
        size = self.persons.groupBy("person").agg((F.count(F.lit(1)) - 1).alias("links"))
        tied = self.persons.join(size, "person").join(self.works.select("id", "work"), "id", "left")
        rows = self.parsed.select("id").join(tied, "id", "left")
        return rows.select("id", F.coalesce("person", F.concat(F.lit("x:"), "id")).alias("person"), "work", F.coalesce("links", F.lit(0)).alias("links"))
