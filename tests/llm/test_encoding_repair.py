import pytest

from tributary.llm.encoding_repair import LOST, Repair, character_counts, repair, single

SOUND = "采购部与质量管理部对单位能耗的口径不同，差额4238已列入清单HT-V4143。" * 3
COUNTS = {ord(c): SOUND.count(c) * 50 for c in set(SOUND + "仓储物流安全环保设备维护客户成功信息技术")}


@pytest.fixture(scope="module")
def fix():
    return Repair(COUNTS)


def double(s):
    return single(single(s.encode(), "cp1252").encode(), "cp1252")


@pytest.mark.parametrize(
    "wrong",
    [lambda s: single(s.encode(), "latin-1"), lambda s: single(s.encode(), "cp1252"), lambda s: single(s.encode(), "mac_roman"), double, lambda s: single(s.encode("gb18030"), "latin-1"), lambda s: single(s.encode("gb18030"), "cp1252")],
)
@pytest.mark.parametrize("text", ["仓储物流部", "安全环保部（北濛）", "Operações MAÇÃ", "Qualité & Méthodes", "“Tarnfield” – oil’s"])
def test_round_trip_whole_and_in_a_passage(fix, wrong, text):
    assert fix(wrong(text)) == (True, text)
    if text[0] > "\x7f":
        assert fix(f"正常的文字。{wrong(text)}\n后面也正常。") == (True, f"正常的文字。{text}\n后面也正常。")


@pytest.mark.parametrize("text", ["供应链运营部", "设备维护部（东屿）"])
def test_utf8_as_gbk(fix, text):
    g, r = fix(text.encode().decode("gb18030", "replace"))
    assert g and r.rstrip(LOST) == text[: len(r.rstrip(LOST))] and len(r) == len(text)


@pytest.mark.parametrize("text", ["采购部", "质量管理部"])
def test_gbk_as_big5(fix, text):
    assert fix(text.encode("gbk").decode("big5")) == (True, text)


@pytest.mark.parametrize("text", [None, "", "plain", "Operações MAÇÃ", "Vertrieb Österfeld", "Ångström 实验室", "拷贝文件", "ガイドを読む", "м³ и Ω", "繁體中文的採購部門", "😀📦", "祥善新能源", SOUND, "·¨" * 0 + "§ 5 Abs. 2 – „Größe“"])
def test_sound_text_stays(fix, text):
    assert fix(text) == (False, text)


def test_lost_text_is_reported(fix):
    assert fix("部门".encode("gbk").decode("utf-8", "replace"))[0]
    assert fix("锟斤拷锟斤拷")[0]


def test_frames(spark):
    df = spark.createDataFrame([(1, "ä»\x93å\x82¨", "x"), (2, None, "x"), (2, None, "x"), (3, "", None), (None, "好" * 50_000, "y")], "k long, text string, restored string")
    rows = repair(df, "text", character_counts(df)).collect()
    assert sorted((r.k or 0, r.garbled) for r in rows) == [(0, False), (1, True), (2, False), (2, False), (3, False)]
    assert next(r.restored for r in rows if r.k == 1) == "仓储"
    assert repair(df.limit(0), "text", {}).count() == 0


def test_copies_of_a_garbled_value_are_no_evidence_for_it(spark):
    wrong = "采购部".encode("gbk").decode("big5")
    texts = [f"采购部与质量管理部的清单{i}" for i in range(40)] + [f"其他{i}" for i in range(160)] + [wrong] * 100
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    rows = repair(df, "text", character_counts(df)).collect()
    assert [(r.garbled, r.restored) for r in rows if r.text == wrong] == [(True, "采购部")] * 100
    assert not any(r.garbled for r in rows if r.text != wrong)


@pytest.mark.parametrize(("text", "kept"), [("安全环保部", "全"), ("法务合规部", "规部"), ("设备维护部", "备维"), ("采购部", "ɹ"), ("海外业务部", "业")])
def test_bytes_that_survived_are_restored(text, kept):
    fix = Repair(COUNTS | {ord(c): 500 for c in "安全环保法务合规设备维护部采购海外业务"})
    wrong = text.encode("gbk").decode("utf-8", "replace")
    garbled, restored = fix(wrong)
    assert garbled and restored.replace(LOST, "") == kept
    assert fix("正常" + LOST + "的文字，500m²" + LOST)[1] == "正常" + LOST + "的文字，500m²" + LOST


def test_a_trace_of_lost_text_spares_other_passages(fix):
    passage = "供应链运营".encode().decode("gb18030", "ignore")
    assert fix(f"锟斤拷锟斤拷 abc {passage}\n")[1].startswith("锟斤拷锟斤拷 abc 供应链运")
