import numpy as np
import pytest

from tributary.llm.encoding_pairs import PAIRS, _sequences, _windows, automaton, prior, read_as, restore
from tributary.llm.encoding_repair import Repair

TEXTS = {
    "shift_jis": ["購買管理システムの運用", "ガイドを読むこと"], "big5": ["採購部門的品質管理"], "euc-kr": ["품질관리팀", "구매관리부서"], "gb18030": ["供应链运营部与质量管理部"],
    "cp1251": ["Отдел закупок и логистики"], "koi8-r": ["Отдел закупок и логистики"], "utf-8": ["供应链运营部与质量管理部", "購買管理システムの運用", "품질관리팀", "Управление качеством"],
}
#: Pairs that lose bytes on the way, so that a text comes back in part at best.
LOSSY = {"shift_jis", "big5", "euc-kr"}


@pytest.mark.parametrize("meant,used", PAIRS)
def test_every_pair_is_flagged(meant, used):
    fix = Repair({})
    for text in TEXTS[meant]:
        assert fix(f"正常的文字。{read_as(text.encode(meant), used)}\n后面。")[0]


@pytest.mark.parametrize("meant,used", [p for p in PAIRS if p[1] not in LOSSY and p[0] in ("utf-8", "cp1251", "koi8-r", "shift_jis") and p[1] != "gb18030"])
def test_restored_in_place(meant, used):
    for text in TEXTS[meant][1:] or TEXTS[meant]:
        assert restore(f"正常的文字。{read_as(text.encode(meant), used)}\n后面。", prior()) == f"正常的文字。{text}\n后面。"


@pytest.mark.parametrize("text", ["", "plain", "37 °C in Östmark, Coralès", "ガイドを読む", "품질관리팀", "Отдел закупок", "繁體中文的採購部門", "供应链运营部", "Größe ≥ 5 µm – “Qualité”", "A" * 9000 + "é" * 2])
def test_sound_text_stays(text):
    assert restore(text, prior()) == text


def test_windows_hold_every_sequence():
    known, first, second, longest = automaton()
    for pair in PAIRS:
        for g in sorted(_sequences(*pair))[::97]:
            text = "前文" + g + "后"
            assert any(a <= 2 and 2 + len(g) <= b for a, b in _windows(text, first, second, longest))
    assert _windows("abc", first, second, longest) == [] and isinstance(first, np.ndarray)


def test_size_of_the_corpus_does_not_change_a_verdict():
    wrong, counts = "质量管理部".encode("gbk").decode("big5"), {ord(c): 60_000 for c in "质量管理部采购仓储物流安全环保设备维护信息技术的与在和为是有"}
    assert {Repair({c: n * k for c, n in counts.items()})(wrong) for k in (10, 1000, 10**6)} == {(True, "质量管理部")}
