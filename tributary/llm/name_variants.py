"""Variant spellings of company names: MinHash banding, Monge-Elkan verification, star clustering.

Names are combined to distinct ones first, and these to distinct signatures (place, brand, line of
business), so that a name that a tenth of all rows carry costs no more than any other. The words of
places, lines of business and familiar affixes are learnt from the names themselves: a word is the
beginning or end of many names and has many different neighbours. Brands are compared by MinHash
signatures over padded 1- and 2-grams; the number of bands follows from the collision curve
1 - (1 - s^r)^b for the least similarity and recall asked for. Pairs that share a band are verified by
the Monge-Elkan similarity of their tokens, and its threshold alone decides. Stars then cluster the
signatures: the most complete and frequent one of a neighbourhood is a centre, its neighbours are its
satellites.

Defined results
* null and blank names take part in nothing; further columns are ignored;
* spellings that differ only in case, width, spaces, legal form or remarks have one signature;
* a short name that fits several companies equally well is linked to none of them;
* ties between centres go to the more frequent one, then to the smaller by code point;
* an empty table gives an empty result; names of any length are compared;
* a few names teach no words: then whole names are compared.
"""

from __future__ import annotations

import math
import re
import unicodedata
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tributary.plans.durable import cut
from tributary.plans.ship import ship

#: Legal forms of companies, and the endings of administrative places.
LEGAL = ["股份有限公司", "有限责任公司", "集团有限公司", "有限公司", "公司", "集团", "股份", "厂"]
LEGAL_LATIN = ["co., ltd.", "co. ltd.", "co.", "ltd.", "limited", "inc.", "corp.", "corporation", "company", "gmbh", "ag", "s.a.", "llc", "plc"]
ADMINISTRATIVE = "省市县区"
#: Traditional characters and their simplified forms.
TRADITIONAL = "團電龍寧裝機嶺創東聯偉進義雲榮陽鋼華達寶潤飛麗誠駿遠鐵澤銳輝貴貞錦鈞鵬馳騰鳳鴻慶紅經緯綸綺繡鈺銀銘銅鋒燁騁蘭蓮藍車軸線纜織儀錶醫療動設備環塑術貿業發興勝凱啟瑞靜蕭蘇穎漢廣滬濟魯島門崗長順質國際實紫綠億邁"
SIMPLIFIED = "团电龙宁装机岭创东联伟进义云荣阳钢华达宝润飞丽诚骏远铁泽锐辉贵贞锦钧鹏驰腾凤鸿庆红经纬纶绮绣钰银铭铜锋烨骋兰莲蓝车轴线缆织仪表医疗动设备环塑术贸业发兴胜凯启瑞静萧苏颖汉广沪济鲁岛门岗长顺质国际实紫绿亿迈"

LEAST_SIMILARITY, RECALL, ROWS = 0.35, 0.99, 2
#: Least Monge-Elkan similarity of two names of one company, and what each token counts.
VERIFIED = 0.81
WEIGHTS = (1, 2, 1)
#: A word is in at least this share of the names and in this many, beside neighbours of this perplexity. A name
#: has at most 16 beginnings and ends, so there are never more than 16 / share words, whatever the data.
WORDS = (0.004, 4, 3.5)
#: The same for the affixes of names that have no legal form, place or line of business.
AFFIXES = (0.025, 5, 2.5)
#: An affix is this many times as common beside bare names as at the same end of the brands of full ones.
RARER = 5
#: A word that extends another has at least this share of its names.
EXTENSION = 0.25
LONGEST_HEAD, LONGEST_TAIL, LONGEST_LATIN = 4, 6, 3
#: Bands that more brands share are joined in blocks of this size.
BLOCK = 2_000
BRANDS_A_TASK = 20_000

_FOLD = str.maketrans(TRADITIONAL, SIMPLIFIED)
_LEGAL = re.compile("(?:" + "|".join(LEGAL) + ")$")
_LEGAL_LATIN = re.compile(r"[ ,](?:" + "|".join(re.escape(x) for x in LEGAL_LATIN) + ")$")
_INSIDE = re.compile(r"\(([^)]*)\)")


@dataclass
class Vocabulary:
    """The words that stand beside brands. Every name in it may be given by the caller instead of learnt."""

    places: frozenset[str] = frozenset()
    businesses: frozenset[str] = frozenset()
    before: frozenset[str] = frozenset()
    after: frozenset[str] = frozenset()
    short: dict[str, str] = field(init=False, repr=False)
    longest: int = field(init=False, repr=False)

    def __post_init__(self) -> None:
        self.short = {b[:n]: b for b in sorted(self.businesses) for n in range(2, len(b))}
        self.longest = max((len(w) for w in self.businesses | self.places | self.before | self.after), default=0)

    def tail(self, s: str, words: frozenset[str] | dict[str, str], rest: int) -> str:
        """The longest of the words that ``s`` ends with, leaving at least ``rest`` characters."""
        return next((s[-n:] for n in range(min(self.longest, len(s) - rest), 0, -1) if s[-n:] in words), "")

    def head(self, s: str, words: frozenset[str], rest: int) -> str:
        return next((s[:n] for n in range(min(self.longest, len(s) - rest), 0, -1) if s[:n] in words), "")


def normal(name: str) -> tuple[str, bool]:
    """(folded name, whether it is latin)."""
    s = unicodedata.normalize("NFKC", name).strip().casefold()
    if re.search("[a-z]", s) and not re.search("[一-鿿]", s):
        return re.sub(r"\s+", " ", s), True
    return re.sub(r"\s", "", s).translate(_FOLD), False


def _remarks(s: str, legal: re.Pattern) -> tuple[str, str]:
    """The name without what is in brackets, and the last of that which is not a remark behind the legal form."""
    place = ""
    for m in _INSIDE.finditer(s):
        if not (m.end() == len(s) and legal.search(s[: m.start()].rstrip())):
            place = m[1].strip()
    return re.sub(" +", " ", _INSIDE.sub("", s)).strip(), place


def parse(name: str, words: Vocabulary) -> tuple[str, str, str]:
    """(place, brand, line of business) of a name, each empty where the name does not say it."""
    s, latin = normal(name)
    return _parse_latin(s, words) if latin else _parse_han(s, words)


def _parse_han(s: str, words: Vocabulary) -> tuple[str, str, str]:
    s, place = _remarks(s, _LEGAL)
    body = _LEGAL.sub("", s)
    formal = body != s
    if "-" in body:
        parts = [p for p in body.split("-") if p]
        business = next((p for p in parts if p in words.businesses), "")
        rest = [p for p in parts if p != business]
        found = next((p for p in rest if p in words.places), min(rest, key=len, default="") if len(rest) > 1 else "")
        return found or place, "".join(p for p in rest if p != found), business
    found = words.head(body, words.places, 2)
    if found:
        place, body = place or found, body[len(found) :]
        if len(body) > 2 and body[0] in ADMINISTRATIVE:
            body = body[1:]
    business = words.tail(body, words.businesses, 2) or words.tail(body, words.short, 2 if formal else 4)
    body = body[: len(body) - len(business)]
    if not formal and not business and not place:
        after = words.tail(body, words.after, 2)
        body = body[: len(body) - len(after)]
        if not after:
            body = body[len(words.head(body, words.before, 2)) :]
    return place, body, business


def _parse_latin(s: str, words: Vocabulary) -> tuple[str, str, str]:
    s, place = _remarks(s, _LEGAL_LATIN)
    s = _LEGAL_LATIN.sub("", s).strip(" ,")
    first, _, last = s.partition(", ")
    if last and (first in words.businesses or first.rstrip(".") in words.short):
        return place, re.sub(r"[\s\-]+", " ", last).strip(" ,."), first.rstrip(".")
    tokens = re.sub(r"[\s\-]+", " ", s).split()
    for n in range(min(3, len(tokens) - 1), 0, -1):
        tail = " ".join(tokens[-n:])
        if tail in words.businesses or tail.endswith(".") and tail[:-1] in words.short and len(tail) > 3:
            return place, " ".join(tokens[:-n]).strip(" ,."), tail.rstrip(".")
    return place, " ".join(tokens).strip(" ,."), ""


def edits(a: str, b: str) -> int:
    """Edit distance with transpositions of neighbours."""
    if a == b:
        return 0
    two, one, row = [], [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        two, one, row = one, row, [i]
        for j, y in enumerate(b, 1):
            d = min(one[j] + 1, row[j - 1] + 1, one[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, two[j - 2] + 1)
            row.append(d)
    return row[-1]


def similarity(a: str, b: str) -> float:
    """Of two tokens: 0.9 where one abbreviates the other, else by edits."""
    if a == b:
        return 1.0
    if min(len(a), len(b)) >= 2 and (a.startswith(b) or b.startswith(a)):
        return 0.9
    return 1 - edits(a, b) / max(len(a), len(b), 1)


def monge_elkan(a: list[str], b: list[str]) -> float:
    """Mean over the tokens of the shorter name of the best similarity in the other."""
    if len(a) > len(b):
        a, b = b, a
    return sum(max(similarity(x, y) for y in b) for x in a) / len(a) if a else 0.0


def _tokens(s: str) -> list[str]:
    return re.split(r"[\s,]+", s)


def score(a: tuple[str, str, str], b: tuple[str, str, str], words: Vocabulary) -> float:
    """Monge-Elkan similarity of two signatures: the mean over the tokens that both say.

    Known words are no misspellings of each other: two of them agree wholly, by abbreviation or not at all.
    """
    (pa, na, ba), (pb, nb, bb) = a, b
    brand = monge_elkan(_tokens(na), _tokens(nb))
    if bool(pa) != bool(pb) and na != nb:  # the place may be misspelt and so part of the brand
        brand = max(brand, similarity(pa + na, pb + nb))
    parts = [(WEIGHTS[1], brand)]
    if pa and pb:
        parts.append((WEIGHTS[0], 0.0 if pa != pb and pa in words.places and pb in words.places else similarity(pa, pb)))
    if ba and bb:
        parts.append((WEIGHTS[2], 1.0 if ba == bb else 0.9 if ba.startswith(bb) or bb.startswith(ba) else 0.0))
    return sum(w * s for w, s in parts) / sum(w for w, _ in parts)


def _pieces(s: str, latin: bool) -> tuple[list[str], bool]:
    """The parts of a name whose beginnings and ends may be words, and whether it is a bare one."""
    if latin:
        s = _LEGAL_LATIN.sub("", _remarks(s, _LEGAL_LATIN)[0]).strip(" ,")
        return ([] if ", " in s else [re.sub(r"[\s\-]+", " ", s)]), False
    plain = _remarks(s, _LEGAL)[0]
    body = _LEGAL.sub("", plain)
    return body.split("-"), body == s and "-" not in s


def _affixes(name: str, words: Vocabulary | None) -> set[tuple[str, str, str]]:
    """(head or tail, beginning or end, what is next to it) of a name; with words, of a bare name or of the brand of a full one."""
    s, latin = normal(name)
    pieces, bare = _pieces(s, latin)
    out: set[tuple[str, str, str]] = set()
    for p in pieces:
        if latin and words is None:
            t = p.split()
            out |= {("tail", " ".join(t[-n:]), t[-n - 1]) for n in range(1, min(LONGEST_LATIN, len(t) - 1) + 1)}
        elif not latin:
            of, shortest = "", 2
            if words is not None:
                place, brand, business = _parse_han(s, words)
                of, shortest = ("" if bare and not place and not business else "brand "), 1
                p = brand if of else p
            out |= {(of + "head", p[:n], p[n]) for n in range(shortest, min(LONGEST_HEAD, len(p) - 1) + 1)}
            out |= {(of + "tail", p[-n:], p[-n - 1]) for n in range(shortest, min(LONGEST_TAIL, len(p) - 1) + 1)}
    return out | {("brand name" if any(x[0].startswith("brand") for x in out) else "name", "", "")} if out else out


def _learnt(names: DataFrame, name: str, limits: tuple[float, int, float], words: Vocabulary | None = None) -> tuple[frozenset[str], frozenset[str]]:
    """(beginnings, ends) of distinct names that have many different neighbours."""
    share, least, perplexity = limits

    @F.pandas_udf("array<struct<side: string, word: string, next: string>>")
    def affixes(column: pd.Series) -> pd.Series:
        return pd.Series([sorted(_affixes(n, words)) for n in column])

    beside = names.select(F.explode(affixes(name)).alias("a")).groupBy("a.side", "a.word", "a.next").agg(F.count("*").alias("k"))
    per = beside.groupBy("side", "word").agg(F.sum("k").alias("n"), F.sum(F.col("k") * F.log("k")).alias("h"))
    spread = F.exp(F.log("n") - F.col("h") / F.col("n"))
    of_brand = F.startswith("side", F.lit("brand"))
    total = F.broadcast(per.agg(*[F.coalesce(F.max(F.when(F.col("side") == x, F.col("n"))), F.lit(0)).alias(y) for x, y in (("name", "total"), ("brand name", "brands"))]))  # one row
    often = F.when(of_brand, F.col("n") >= share / RARER * F.col("brands")).otherwise((F.col("n") >= F.greatest(F.lit(float(least)), share * F.col("total"))) & (spread >= perplexity))
    rows = per.crossJoin(total).filter(often & (F.col("word") != "")).select("side", "word", "n", (F.col("n") / F.when(of_brand, F.col("brands")).otherwise(F.col("total"))).alias("share")).collect()
    n = {(r.side, r.word): r.n for r in rows}
    shares = {(r.side, r.word): r.share for r in rows}

    def own(side: str, word: str) -> bool:
        inner = (word[:k] if side == "head" else word[-k:] for k in range(1, len(word)))
        return shares[side, word] >= RARER * shares.get((f"brand {side}", word), 0) and all(n[side, word] >= EXTENSION * n.get((side, w), 0) for w in inner)

    return tuple(frozenset(w for s, w in n if s == side and own(s, w)) for side in ("head", "tail"))


def learn(names: DataFrame, name: str = "name") -> Vocabulary:
    """The words of distinct names, from all of them."""
    heads, tails = _learnt(names, name, WORDS)
    words = Vocabulary(heads, tails)
    before, after = _learnt(names, name, AFFIXES, words)
    return Vocabulary(heads, tails, before - heads, after - tails)


def bands(least: float = LEAST_SIMILARITY, recall: float = RECALL, rows: int = ROWS) -> int:
    """The fewest bands whose collision curve reaches the recall at the least similarity."""
    return math.ceil(math.log(1 - recall) / math.log(1 - least**rows))


def _signature_udf(words: Vocabulary):
    @F.pandas_udf("place string, brand string, business string")
    def signature(names: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([parse(n, words) for n in names], columns=["place", "brand", "business"])

    return signature.asNondeterministic()  # else a filter on its result is pushed below the aggregation to distinct names


def _score_udf(words: Vocabulary):
    @F.pandas_udf("double")
    def verify(a: pd.DataFrame, b: pd.DataFrame) -> pd.Series:
        return pd.Series([score(x, y, words) for x, y in zip(a.itertuples(index=False, name=None), b.itertuples(index=False, name=None), strict=True)], dtype=float)

    return verify.asNondeterministic()  # evaluated once, not again in the filter on its result


def candidates(brands: DataFrame, least: float = LEAST_SIMILARITY, recall: float = RECALL, rows: int = ROWS, block: int = BLOCK) -> DataFrame:
    """(brand_a, brand_b), each distinct pair of brands that shares a band, once.

    A band that more than ``block`` brands share is joined in blocks, each with each, so that no task has
    more than ``block`` squared pairs of it and none is lost.
    """
    padded = F.concat(F.lit("\u0002"), F.col("brand"), F.lit("\u0003"))
    ones = F.transform(F.sequence(F.lit(1), F.length("brand")), lambda i: F.substring(F.col("brand"), i, F.lit(1)))
    twos = F.transform(F.sequence(F.lit(1), F.length("brand") + 1), lambda i: F.substring(padded, i, F.lit(2)))
    hashes = F.transform(F.sequence(F.lit(0), F.lit(bands(least, recall, rows) * rows - 1)), lambda k: F.array_min(F.transform(F.col("grams"), lambda g: F.xxhash64(k, g))))
    keys = F.transform(F.sequence(F.lit(0), F.lit(bands(least, recall, rows) - 1)), lambda k: F.xxhash64(k, *[F.element_at(F.col("mins"), k * rows + (i + 1)) for i in range(rows)]))
    # few rows of much work: spread by number, for partitions merged by size would be one task
    spread = brands.repartition(max(brands.sparkSession.sparkContext.defaultParallelism, brands.count() // BRANDS_A_TASK))
    signed = spread.withColumn("grams", F.array_distinct(F.concat(ones, twos))).withColumn("mins", hashes)
    banded = cut(signed.select("brand", F.explode(keys).alias("band")))
    blocks = banded.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1").select("band", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    # merge hints: the size that is known before bands are exploded must not choose a broadcast
    shared = banded.hint("merge").join(blocks.hint("merge"), "band").withColumn("own", F.pmod(F.xxhash64("brand"), F.col("blocks")).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    a = shared.select("band", F.col("own").alias("i"), every.alias("j"), F.col("brand").alias("brand_a"))
    b = shared.select("band", F.col("own").alias("j"), every.alias("i"), F.col("brand").alias("brand_b"))
    return a.hint("merge").join(b.hint("merge"), ["band", "i", "j"]).filter("brand_a < brand_b").select("brand_a", "brand_b").distinct()


def _possible(verified: float) -> Column:
    """Whether brand_a and brand_b can reach the score at all, whatever else their names say.

    The other tokens count as much as the brand at most, so its similarity is bounded from below and its
    edits from above; one transposition is two edits here. A longer brand may hold a misspelt place.
    """
    a, b = F.col("brand_a"), F.col("brand_b")
    least = (verified * sum(WEIGHTS) - WEIGHTS[0] - WEIGHTS[2]) / WEIGHTS[1]
    longer, shorter = F.greatest(F.length(a), F.length(b)), F.least(F.length(a), F.length(b))
    most = F.floor((longer + 1) * (1 - least)) * 2
    apart = longer - shorter
    return a.contains(" ") | b.contains(" ") | a.startswith(b) | b.startswith(a) | (F.levenshtein(a, b) <= most + F.when(apart > 1, apart).otherwise(0))


def _edges(signatures: DataFrame, words: Vocabulary, verified: float = VERIFIED) -> DataFrame:
    """(a, b, score) in both directions: pairs of signatures whose score reaches ``verified``.

    Two different known lines of business or places leave a score of at most 0.75, so above that such
    pairs are not even formed: businesses that agree share their beginning, which is part of the key.
    """
    brands = cut(signatures.select("brand").distinct())
    both = candidates(brands).filter(_possible(verified)).unionByName(brands.select(F.col("brand").alias("brand_a"), F.col("brand").alias("brand_b")))
    none, start = F.col("business") == "", F.substring("business", 1, 2)
    keys = {
        "a": F.when(none, F.array(F.lit("0"))).otherwise(F.array(start, F.lit("1"))),
        "b": F.when(none, F.array(F.lit("0"), F.lit("1"))).otherwise(F.array(start, F.lit("0"))),
    }
    side = lambda x: signatures.select(F.col("id").alias(x), F.col("brand").alias(f"brand_{x}"), F.struct("place", "brand", "business").alias(f"s{x}"), F.col("known").alias(f"known_{x}"), F.explode(keys[x] if verified > 0.75 else F.array(F.lit("0"))).alias("key"))
    joined = both.join(side("a"), "brand_a").join(side("b"), ["brand_b", "key"]).filter((F.col("brand_a") < F.col("brand_b")) | (F.col("a") < F.col("b")))
    if verified > 0.75:
        place = lambda x: F.col(f"s{x}.place")
        joined = joined.filter((place("a") == place("b")) | ~F.col("known_a") | ~F.col("known_b"))
    scored = joined.select("a", "b", _score_udf(words)("sa", "sb").alias("score")).filter(F.col("score") >= verified)
    return scored.unionByName(scored.select(F.col("b").alias("a"), F.col("a").alias("b"), "score"))


def stars(vertices: DataFrame, edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """(id, centre) of every vertex: star clustering by local maxima of the vertices' rank.

    ``vertices`` has id, weight and full (whether it may decide between centres); ``edges`` has both
    directions. In each round the vertices that outrank all unassigned neighbours become centres, and
    their unassigned neighbours satellites of the best of them; where an incomplete vertex fits two
    centres of a round equally well it stays alone.
    """
    rank = F.struct("weight", "id")
    open_ = cut(vertices.select("id", "weight", "full"))
    edges = cut(edges)
    done = None
    for _ in range(max_rounds):
        ranks = open_.select(F.col("id").alias("b"), F.col("weight").alias("wb"))
        live = edges.join(open_.select(F.col("id").alias("a"), F.col("weight").alias("wa"), "full"), "a").join(ranks, "b")
        best = live.groupBy("a").agg(F.max(F.struct(F.col("wb").alias("weight"), F.col("b").alias("id"))).alias("top"))
        j = open_.join(best, open_["id"] == best["a"], "left")
        centres = j.filter(F.col("top").isNull() | (rank > F.col("top"))).select("id")
        to = live.join(centres.withColumnRenamed("id", "b"), "b").join(centres.withColumnRenamed("id", "a"), "a", "left_anti")
        order = Window.partitionBy("a").orderBy(F.desc("score"), F.desc("wb"), "b")
        choice = to.withColumn("n", F.row_number().over(order)).withColumn("second", F.lead("score").over(order)).filter("n = 1")
        alone = ~F.col("full") & (F.col("score") == F.coalesce("second", F.lit(0.0)))
        sat = choice.select(F.col("a").alias("id"), F.when(alone, F.col("a")).otherwise(F.col("b")).alias("centre"))
        new = cut(centres.select("id", F.col("id").alias("centre")).unionByName(sat))
        done = new if done is None else done.unionByName(new)
        open_ = cut(open_.join(new.select("id"), "id", "left_anti"))
        if open_.isEmpty():
            return done
    raise RuntimeError(f"star clustering did not end in {max_rounds} rounds")


def clusters(names: DataFrame, name: str = "name", words: Vocabulary | None = None, verified: float = VERIFIED) -> DataFrame:
    """(name, entity): each distinct spelling and the name's cluster; names may repeat.

    The words are learnt from these names unless given.
    """
    ship(names)
    distinct = cut(names.filter(F.trim(name) != "").groupBy(F.col(name).alias("name")).agg(F.count("*").alias("n")))
    words = words or learn(distinct)
    parsed = distinct.withColumn("s", _signature_udf(words)("name")).select("name", "n", "s.*").filter("brand <> ''")
    parsed = cut(parsed.withColumn("id", F.concat_ws("\u0001", "place", "brand", "business")))
    fields = (F.col("place") != "").cast("int") + 2 * F.col("business").isin(*words.businesses).cast("int") + (F.length("brand") > 2).cast("int")
    signatures = parsed.groupBy("id", "place", "brand", "business").agg(F.sum("n").alias("n")).withColumn("known", F.col("place").isin(*words.places))
    vertices = signatures.select("id", F.struct(fields.alias("fields"), "n").alias("weight"), (F.col("business") != "").alias("full"))
    found = stars(vertices, _edges(signatures, words, verified))
    return parsed.join(found, "id").select("name", F.col("centre").alias("entity"))


def variant_pairs(clustered: DataFrame) -> DataFrame:
    """(name_a, name_b), name_a < name_b by code point: the spellings of each entity."""
    a, b = clustered.select("entity", F.col("name").alias("name_a")), clustered.select("entity", F.col("name").alias("name_b"))
    return a.join(b, "entity").filter("name_a < name_b").select("name_a", "name_b")

