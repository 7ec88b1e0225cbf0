import itertools
import random

import pytest

from tributary.llm import name_variants
from tributary.llm.name_variants import SIMPLIFIED, TRADITIONAL, Vocabulary, bands, candidates, clusters, edits, learn, monge_elkan, score, similarity, stars, variant_pairs

WORDS = Vocabulary(
    frozenset({"北濛", "东屿"}), frozenset({"医疗器械", "线缆", "精密机械", "化工材料", "castings"}), frozenset({"老"}), frozenset({"老板", "那边", "家"})
)


def parse(name):
    return name_variants.parse(name, WORDS)


SAME = [
    "北濛创莲柏纶医疗器械股份有限公司", "北濛创莲柏纶医疗器械", "创莲柏纶股份", "创莲柏纶（北濛）医疗器械", "北濛莲创柏纶医疗器械股份有限公司", "医疗器械-创莲柏纶-北濛", "老创莲柏纶",
    "创莲老板", "北濛市创莲柏纶医疗器械股份有限公司", "北濛创莲柏纶医疗公司", "北濛 創莲柏纶 医疗器械股份有限公司 ", "北濛创莲柏纶医疗器械股份有限公司（停用）", "北濛创莲柏医疗器械公司",
]
OTHER = ["北濛创莲柏纶线缆股份有限公司X".rstrip("X"), "北濛利创溪隆精密机械股份有限公司", "利创溪隆"]
LATIN = ["Zotitima Castings S.A.", "ZOTITIMA CASTINGS S.A.", "Zotitima Cast. S.A.", "Zotitima-Castings", "Castings, Zotitima", "Zotitma Castings S.A.", "Zotitima (Brénoux)", "Zotitima S.A."]


def test_parse():
    assert parse("东屿麒雪光朱化工材料有限责任公司（原厂）") == parse("麒雪光朱(東屿)化工材料") == ("东屿", "麒雪光朱", "化工材料")
    assert parse("化工材料-麒雪光朱-东屿") == ("东屿", "麒雪光朱", "化工材料")
    assert parse("仁信老板")[1] == "仁信" and parse("老泽都荷江")[1] == "泽都荷江"
    assert parse("Rawodome (Coralès)") == ("coralès", "rawodome", "")
    assert len(TRADITIONAL) == len(SIMPLIFIED)


def test_edits():
    assert [edits(a, b) for a, b in [("", ""), ("ab", "ba"), ("abc", "ac"), ("abcd", "abxcd"), ("kitten", "sitting")]] == [0, 1, 1, 1, 3]
    assert similarity("化工材料", "化工") == 0.9 and monge_elkan(["a"], ["b", "a"]) == 1


def test_bands():
    for least, recall, rows in [(0.35, 0.99, 2), (0.6, 0.9, 3)]:
        b = bands(least, recall, rows)
        assert 1 - (1 - least**rows) ** b >= recall > 1 - (1 - least**rows) ** (b - 1)


def test_candidate_recall(spark):
    r = random.Random(4)
    pool = [chr(0x4E00 + i) for i in range(120)]
    brands = {"".join(r.choices(pool, k=4)) for _ in range(150)}
    typed = {b: b[:1] + b[2] + b[1] + b[3:] for b in brands} | {b + "!": b for b in ()}
    rows = [(x,) for x in brands | set(typed.values())]
    got = {(x.brand_a, x.brand_b) for x in candidates(spark.createDataFrame(rows, "brand string")).collect()}
    want = [tuple(sorted(p)) for p in typed.items() if p[0] != p[1]]
    assert sum(p in got for p in want) >= 0.97 * len(want)


def test_stars(spark):
    v = spark.createDataFrame([("a", 5, True), ("b", 1, True), ("c", 1, True), ("d", 4, True), ("e", 1, False), ("x", 1, True)], "id string, weight int, full boolean")
    pairs = [("a", "b", 0.9), ("b", "c", 0.9), ("c", "d", 0.8), ("a", "e", 0.9), ("d", "e", 0.9)]
    e = spark.createDataFrame(pairs + [(y, x, s) for x, y, s in pairs], "a string, b string, score double")
    assert {r.id: r.centre for r in stars(v, e).collect()} == {"a": "a", "b": "a", "c": "d", "d": "d", "e": "e", "x": "x"}


def test_clusters(spark):
    names = [n for n in SAME + LATIN + OTHER for _ in range(2)] + [SAME[0]] * 20 + [LATIN[0]] * 9 + [OTHER[1]] * 9 + [None, "", "  ", "甲" * 5000]
    got = {(r.name_a, r.name_b) for r in variant_pairs(clusters(spark.createDataFrame([(n, "c") for n in names], "name string, entity string"), words=WORDS)).collect()}
    want = {tuple(sorted(p)) for group in (SAME, LATIN, OTHER[1:]) for p in itertools.combinations(group, 2)}
    # a short form of a brand with two lines of business fits both
    open_ = {n for n in SAME if not parse(n)[2]}
    assert {p for p in got if not open_ & set(p)} == {p for p in want if not open_ & set(p)}
    assert got <= want


@pytest.mark.parametrize("rows", [[], [(None,)]])
def test_empty(spark, rows):
    assert variant_pairs(clusters(spark.createDataFrame(rows, "name string"))).count() == 0


def invented(n, seed=8):
    """Companies with words that no list holds, each in several spellings; one place has a third of them."""
    r = random.Random(seed)
    letters = [chr(c) for c in range(0x5200, 0x52C8)]
    places = ["卡溪", "卢坪", "卫堰", "卯桥", "印浦", "危岭"]
    trades = ["厌氧装置", "厨具", "原木加工", "厢车改装", "厦材"]
    groups = []
    for _ in range(n):
        place, trade, brand = r.choice(places + [places[0]] * 3), r.choice(trades), "".join(r.sample(letters, 4))
        typo = brand[:2] + brand[3] + brand[2]
        groups.append({
            f"{place}{brand}{trade}有限公司", f"{brand}（{place}）{trade}有限公司", f"{trade}-{brand}-{place}", f"{place}{typo}{trade}有限公司", f"{place}{brand}{trade}厂（停用）", f"{place}{brand}", brand, f"老{brand}",
        })
    return groups, places, trades


def test_learnt_words_and_recall(spark):
    groups, places, trades = invented(160)
    names = spark.createDataFrame([(n,) for g in groups for n in g], "name string")
    words = learn(names)
    assert words.places == set(places) and words.businesses == set(trades) and "老" in words.before
    got = {(r.name_a, r.name_b) for r in variant_pairs(clusters(names)).collect()}
    want = {tuple(sorted(p)) for g in groups for p in itertools.combinations(g, 2)}
    assert len(got & want) >= 0.99 * len(want) and len(got & want) >= 0.99 * len(got)
    strict = {(r.name_a, r.name_b) for r in variant_pairs(clusters(names, verified=0.95)).collect()}
    assert strict < got, "the threshold decides which pairs are linked"


def test_score():
    full = ("北濛", "创莲柏纶", "医疗器械")
    linked = [("北濛", "莲创柏纶", "医疗器械"), ("", "创莲柏纶", ""), ("", "创莲", ""), ("北濛", "创莲柏纶", "医疗"), ("北蒙", "创莲柏纶", "医疗器械"), ("", "北蒙创莲柏纶", "医疗器械")]
    apart = [("东屿", "创莲柏纶", "医疗器械"), ("北濛", "创莲柏纶", "线缆"), ("北濛", "创金石纶", "医疗器械"), ("", "石创", "")]
    assert all(score(full, x, WORDS) >= name_variants.VERIFIED for x in linked)
    assert all(score(full, x, WORDS) < name_variants.VERIFIED for x in apart)
    assert score(("", "john smith", ""), ("", "smith, john", ""), WORDS) == 1


def test_bound_before_the_score_loses_nothing(spark):
    r = random.Random(3)
    letters = "甲乙丙丁戊己"
    sigs = [(r.choice(["", "北濛", "北蒙", "东屿"]), "".join(r.choices(letters, k=r.choice([2, 3, 4, 4, 5]))), r.choice(["", "线缆", "医疗", "医疗器械"])) for _ in range(250)]
    sigs = sorted(set(sigs))
    df = spark.createDataFrame([("|".join(x), *x, x[0] in WORDS.places) for x in sigs], "id string, place string, brand string, business string, known boolean")
    got = {(x.a, x.b) for x in name_variants._edges(df, WORDS).collect()}
    pairs = {(x.brand_a, x.brand_b) for x in candidates(df.select("brand").distinct()).collect()}
    want = {(("|".join(a)), "|".join(b)) for a, b in itertools.permutations(sigs, 2) if score(a, b, WORDS) >= name_variants.VERIFIED and (a[1] == b[1] or tuple(sorted((a[1], b[1]))) in pairs)}
    assert got == want


def test_blocks_of_a_hot_band_lose_no_pair(spark):
    brands = spark.createDataFrame([("甲" + chr(0x4E00 + i),) for i in range(80)], "brand string")
    assert set(candidates(brands, block=7).collect()) == set(candidates(brands).collect())
