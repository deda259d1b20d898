import itertools
import random

import pytest

from millsheet.llm.sentences import Tagger, split_sentences, train

CASES = [
    ["The plate, approx. 15.0 m long, was cut, cf. fig. 3.", "e.g. the nozzle needs a coat.", "Stop!", "Why was it (No. 4) released at 3.6 bar?", "Ref. RT-74152 replaces it..."],
    ['The inspector wrote: "Hold point reached. Do not continue." on sheet NC-1.', "According to Dr. Helrum the site, Bldg. 3, accepts it from 7 a.m. to 4 p.m. only."],
    ["Le contrôleur a noté : « Point d'arrêt atteint. Ne pas poursuivre. » sur la feuille PV-1.", "Arrêtez si le coude bouge de plus de 5,10 mm !", "p. ex. le coude demande une couche, c.-à-d. au-dessus de EN 10204."],
    ["Das Blech ist ca. 9 m lang und wurde am 9. Juni zugeschnitten.", "Der Prüfer schrieb: „Halt. Nicht weiter.“ auf Blatt 7.", "Es wurden keine Risse usw. gefunden."],
    ["De keurmeester schreef: 'Stoppunt bereikt. Niet verder gaan.' op blad RT-1.", "Volgens dhr. Vonmut is dat zo."],
    ["¿Por qué se liberó antes de la prueba a 28,9 bar?", "¡Detenga el trabajo!", "Según el Sr. Lob es así."],
    ["वेल्डर ने जाँच की।", "डॉ. Siglob के अनुसार 61888 कि.ग्रा. सामग्री है।", "क्यों छोड़ा गया?"],
    ["تم تسليم الكوع بسماكة 36.00 مم.", "أوقفوا العمل فورًا!", "كتب المفتش: «تم بلوغ النقطة. لا تتابع.» على الورقة 7."],
]


#: Sentences in scripts without blanks.
DENSE = [["检验员写道：“到达停止点。不得继续。”随后在NC-65485上签字。", "如果接管移动，请立即停止工作！", "为什么接管放行了？"], ["検査員は「停止。続けないこと。」とFC-1に書いた。", "肉厚は3.6ミリである。", "なぜ出荷されたのか？"]]
GLUED = ["The parts are shipped.", "The plate is 3.6 mm.", "Stop the work!"]


@pytest.fixture(scope="module")
def tagger():
    """Trained on texts whose sentences aren't marked: paragraphs of one to four sentences."""
    rng = random.Random(7)
    texts = []
    for k in range(900):
        of = (CASES + DENSE + [GLUED])[k % (len(CASES) + 3)]
        gap = "" if of in DENSE or rng.random() < 0.03 else " "
        texts.append("\n\n".join(gap.join(rng.choices(of, k=rng.randint(1, 4))) for _ in range(3)))
    return train(texts)


@pytest.mark.parametrize("sentences", CASES)
def test_languages_and_layouts(tagger, sentences):
    for gap in (" ", "  ", "\n", "\n\n", "\n \n\n"):
        text = gap.join(sentences)
        assert [text[a:b] for a, b in tagger.units(text)] == sentences
    wrapped = " ".join(sentences).replace(" ", "\n", 3)
    assert [wrapped[a:b].replace("\n", " ") for a, b in tagger.units(wrapped)] == sentences


def test_scripts_without_blanks_and_glued_sentences(tagger):
    text = "检验员写道：“到达停止点。不得继续。”随后在NC-65485上签字。如果接管移动，请立即停止工作！検査員は「停止。続けないこと。」とFC-1に書いた。"
    assert [text[a:b] for a, b in tagger.units(text)] == ["检验员写道：“到达停止点。不得继续。”随后在NC-65485上签字。", "如果接管移动，请立即停止工作！", "検査員は「停止。続けないこと。」とFC-1に書いた。"]
    text = "The parts are shipped.The plate is 3.6 mm.Stop the work!"
    assert [text[a:b] for a, b in tagger.units(text)] == ["The parts are shipped.", "The plate is 3.6 mm.", "Stop the work!"]


def test_labels_and_numbers(tagger):
    text = "Order no. = PRJ-1\nSupplier : A. B. Inc.\n\n48207 / 36905\n\nThe inspector wrote: \"Go.\" on\nsheet 7\n\n"
    assert [text[a:b] for a, b in tagger.units(text)] == ["Order no. = PRJ-1", "Supplier : A. B. Inc.", "48207 / 36905", 'The inspector wrote: "Go." on\nsheet 7']
    assert tagger.units("") == tagger.units(" \n\n ") == []


THAI = ["ไม่พบรอยแตกบนหน้าแปลน", "ผู้ตรวจสอบลงนามในใบ PV-1419 แล้วส่งคืนให้ผู้ผลิต", "อุณหภูมิอยู่ที่ 15879 °C ซึ่งสูงกว่าค่าต่ำสุด", "หน้าแปลนส่งมอบพร้อมความหนา 28.7 มม.", "รายการที่ 21 รวมวัสดุ 84054 กก."]


def test_trained_on_text_without_punctuation():
    rng = random.Random(1)
    corpus = ["\n\n".join(" ".join(rng.choices(THAI, k=rng.randint(1, 3))) for _ in range(4)) for _ in range(60)]
    tagger = train(corpus)
    for _ in range(30):
        s = rng.choices(THAI, k=6)
        text = " ".join(s)
        assert [text[a:b] for a, b in tagger.units(text)] == s


def test_viterbi_forbids_empty_sentences():
    t = Tagger()
    assert t.decode([3.0, 3.0], [3, 0]) == [True, False]
    assert t.decode([3.0, 3.0], [3, 3]) == [True, True]
    assert t.decode([-1.0], [3]) == [False]
    assert t.decode([], []) == []


def test_viterbi_is_exact():
    rng = random.Random(8)
    for _ in range(100):
        n = rng.randint(1, 8)
        scores, sizes = [rng.uniform(-3, 3) for _ in range(n)], [rng.randrange(4) for _ in range(n)]
        t = Tagger(None, [rng.uniform(-4, 1) for _ in range(4)])
        value = lambda tags: sum(e + (t.transitions[d] if i and tags[i - 1] else 0.0) for i, (e, d, on) in enumerate(zip(scores, sizes, tags)) if on)  # noqa: E731, B023
        assert abs(value(t.decode(scores, sizes)) - max(map(value, itertools.product((False, True), repeat=n)))) < 1e-9


def test_abbreviations_are_learned(tagger):
    """A word that no list has and that never ends a paragraph is none that ends a sentence."""
    rng = random.Random(9)
    texts = ["\n\n".join(" ".join(rng.choice(["Der Stutzen nach Zkf. Weber ist neu.", "Laut Zkf. Nord gilt das.", "Die Naht ist dicht.", "Es wurde geprüft."]) for _ in range(rng.randint(1, 3))) for _ in range(3)) for _ in range(150)]
    text = "Die Naht ist dicht. Laut Zkf. Nord gilt das. Es wurde geprüft."
    assert [text[a:b] for a, b in train(texts).units(text)] == ["Die Naht ist dicht.", "Laut Zkf. Nord gilt das.", "Es wurde geprüft."]


def test_table(spark):
    rows = [(1, "Ab cd. Ef gh.", "c"), (2, None, None), (3, "", None), (None, "x.", None), (4, "Wort und Zahl. " * 20000, None), (5, "😀 Ab cd. Ef.", None)]
    d = spark.createDataFrame(rows, "doc_id long, text string, sent_no string")
    got = split_sentences(d).collect()
    assert [(r.sent_no, r.start_pos, r.end_pos) for r in got if r.doc_id == 1] == [(1, 0, 6), (2, 7, 13)]
    assert [(r.start_pos, r.end_pos) for r in got if r.doc_id == 5] == [(0, 8), (9, 12)]
    assert sum(r.doc_id == 4 for r in got) == 20000
    assert {r.doc_id for r in got} == {1, 4, 5}
    assert split_sentences(d.limit(0)).count() == 0


def test_repeated_rows_count_once(spark):
    d = spark.createDataFrame([(1, "Ab cd. Ef gh."), (2, "Ab cd."), (1, "Ab cd. Ef gh.")], "doc_id long, text string")
    assert sorted(tuple(r) for r in split_sentences(d).collect()) == [(1, 1, 0, 6), (1, 2, 7, 13), (2, 1, 0, 6)]
