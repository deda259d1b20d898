import random

import numpy as np

from millsheet.llm import language as G
from millsheet.llm.queries import p5_segments
from millsheet.operators.quantities import document_key

TEXTS = {
    "en": ["The inspector found no crack on the weld.", "Please return the signed copy before the parts are shipped.", "All results are given in the report and remain valid for this lot.", "The plate was cut by the welder yesterday morning."],
    "fr": ["Le contrôleur n'a relevé aucune fissure sur la soudure.", "Merci de renvoyer la copie signée avant l'expédition des pièces.", "Les résultats figurent dans le rapport et ne valent que pour ce lot.", "La tôle a été débitée hier matin par le soudeur."],
    "de": ["Der Prüfer hat keine Risse an der Naht gefunden.", "Bitte senden Sie die unterschriebene Kopie vor dem Versand zurück.", "Alle Ergebnisse stehen im Bericht und gelten nur für dieses Los.", "Das Blech wurde gestern vom Schweißer zugeschnitten."],
    "ja": ["割れや気孔などの欠陥は見つからなかった。", "すべての結果は報告書に示し、このロットにのみ有効である。", "溶接工は目視検査の後に継手を補修した。", "フランジが動いた場合は直ちに作業を止めること。"],
    "th": ["ไม่พบรอยแตกหรือรูพรุนบนหน้าแปลน", "ผลการทดสอบทั้งหมดอยู่ในรายงานแนบและใช้ได้เฉพาะชุดนี้", "ช่างเชื่อมซ่อมข้องอหลังการตรวจด้วยสายตา", "กรุณาหยุดงานทันทีหากท่อเคลื่อนที่"],
}


def _labelled(wrong=0.1):
    rng = random.Random(2)
    out = []
    for k, ts in TEXTS.items():
        for _ in range(40):
            out.append((" ".join(rng.sample(ts, 3)), rng.choice(list(TEXTS)) if rng.random() < wrong else k))
    return out


def test_labels():
    assert [G.label_code(x) for x in ("fr", "Fr ", "fr-FR", "français", "eng", "en_GB", "日本語", "Deutsch", "العربية")] == ["fr", "fr", "fr", "fr", "en", "en", "ja", "de", "ar"]
    assert [G.label_code(x) for x in (None, "", "  ", "und", "unk", "??", "xx")] == [None] * 7


def test_products_equal_the_kernel_matrix():
    texts = [G.plain(t) for ts in TEXTS.values() for t in ts]
    sets = []
    for t in texts:
        who, g, _ = G.grams([t])
        sets.append(set(g.tolist()))
    land = np.zeros((G.SPACE, len(texts)), np.float32)
    for j, s in enumerate(sets):
        land[list(s), j] = 1 / np.sqrt(len(s))
    k = G.products(texts, land)
    want = [[len(a & b) / np.sqrt(len(a) * len(b)) for b in sets] for a in sets]
    assert np.allclose(k, want, atol=1e-5)
    assert np.allclose(np.diag(k), 1, atol=1e-5)


def test_held_out_accuracy_in_spite_of_wrong_labels():
    r = G.Reader(G.train(_labelled()))
    held = {"en": "No crack was found on the plate of the inspector.", "fr": "Aucune fissure n'a été relevée sur la tôle.", "de": "Am Blech wurden keine Risse gefunden.", "ja": "継手の欠陥は見つからなかった。", "th": "ไม่พบรอยแตกบนข้องอ"}
    for k, t in held.items():
        ((_, _, got, c),) = r.read([t])[0]
        assert got == k
        assert 0.5 < c <= 1


def test_wrong_labels_of_one_script_that_sort_first():
    wrong = [(" ".join(TEXTS["fr"][i : i + 2]) + f" {n}", "ja") for n in range(4) for i in range(3)]
    r = G.Reader(G.train(_labelled(0.0) + wrong))
    assert [x[2] for x in r.read([TEXTS["fr"][0] + " " + TEXTS["fr"][3]])[0]] == ["fr"]
    assert [x[2] for x in r.read(["".join(TEXTS["ja"])])[0]] == ["ja"]


def test_wrong_labels_of_a_rare_language():
    labelled = [(" ".join(ts[i % 3 : i % 3 + 2]) + f" {k}{i}", k) for k, ts in TEXTS.items() for i in range(6 if k == "th" else 60)]
    labelled += [(" ".join(TEXTS["fr"][:3]), "th"), (" ".join(TEXTS["fr"][1:]), "th"), (" ".join(TEXTS["th"][:2]), "fr")]
    r = G.Reader(G.train(labelled))
    for k, ts in TEXTS.items():
        for t in ts:
            assert [x[2] for x in r.read([t])[0]] == [k], t


def test_without_labels_the_fixed_sentences_decide():
    r = G.Reader(G.train([]))
    assert [[x[2] for x in r.read([" ".join(ts)])[0]] for k, ts in TEXTS.items() if k in ("ja", "th", "de")] == [["de"], ["ja"], ["th"]]


def test_stretches_and_texts_without_words():
    r = G.Reader(G.train(_labelled()))
    mixed = "Supplier : ACME Ltd\n\n" + " ".join(TEXTS["fr"]) + "\n\n" + " ".join(TEXTS["de"]) + "\n\n" + " ".join(TEXTS["th"]) + "\n\n" + "".join(TEXTS["ja"])
    got = r.read([mixed, None, "", "  \n ", "123 / 456 / 789", "Order no. : WO-12", " ".join(TEXTS["en"]) * 3000])
    assert [x[2] for x in got[0]] == ["fr", "de", "th", "ja"]
    assert all(a[1] == b[0] for a, b in zip(got[0], got[0][1:]))
    assert got[1] == got[2] == got[3] == got[4] == got[5] == []
    assert [x[2] for x in got[6]] == ["en"]


def test_table(spark):
    docs = [(i, t, k, f"D{i}") for i, (t, k) in enumerate(_labelled(0.0))]
    docs += [(900, " ".join(TEXTS["de"]), "fr", "D900"), (901, " ".join(TEXTS["de"]), None, "D901"), (902, " ".join(TEXTS["de"]), "deutsch", "D902"), (903, " ".join(TEXTS["de"]) + "\n\n" + " ".join(TEXTS["fr"]), "de", None), (904, None, "de", None), (905, "", None, None), (None, "x", "de", None)]
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string, document_name string")
    pages = [(1, "D900", " ".join(TEXTS["de"])), (2, "d900.pdf", ""), (3, "D901", " ".join(TEXTS["de"])), (4, "D901", " ".join(TEXTS["fr"])), (5, "D902", " ".join(TEXTS["en"]) + "\n\n" + " ".join(TEXTS["fr"])), (5, "D902", " ".join(TEXTS["en"]) + "\n\n" + " ".join(TEXTS["fr"])), (6, None, " ".join(TEXTS["fr"])), (7, "D903", None)]
    p = spark.createDataFrame(pages, "ocr_id long, document_name string, full_text string")
    seeds = [(1, "D900.pdf", "fr"), (2, "D900.pdf", "de"), (3, "D901.pdf", None), (4, "D902.pdf", None), (5, None, None), (6, "D999.pdf", None), (1, "D900.pdf", "fr")]
    s = spark.createDataFrame(seeds, "seed_id long, filename string, language string")
    got = sorted(tuple(r) for r in G.find_languages(d, s, p, document_key).collect())
    assert got == [("documents", 900, 0, "de"), ("documents", 901, 0, "de"), ("documents", 903, 1, "de"), ("documents", 903, 2, "fr"), ("ocr_result", 5, 1, "en"), ("ocr_result", 5, 2, "fr"), ("seed_record", 1, 0, "de")]
    none = [x.limit(0) for x in (d, s, p)]
    assert G.find_languages(*none, document_key).count() == 0


def test_one_sentence_beside_a_script_without_final_punctuation():
    r = G.Reader(G.train(_labelled(0.0)))
    th = " ".join(TEXTS["th"])
    for k in ("en", "fr", "de", "ja"):
        for t, want in ((f"{th} {TEXTS[k][0]}", ["th", k]), (f"{TEXTS['th'][1]} {' '.join(TEXTS[k])}", ["th", k]), (f"{TEXTS[k][0]} {th}", [k, "th"]), (f"{' '.join(TEXTS[k])} {TEXTS['th'][1]}", [k, "th"])):
            got = r.read([t])[0]
            assert [x[2] for x in got] == want, t
            assert t[got[1][0] :].startswith((TEXTS["th"][0], TEXTS["th"][1], TEXTS[k][0]))


def test_names_and_codes_stay_with_the_script_around_them():
    t = f"{TEXTS['th'][0]} Dupont Metal Works {TEXTS['th'][1]} WPS-19069 PT 12 °C {TEXTS['th'][2]}"
    assert G.pieces(t) == [(0, t)]


def test_repeated_rows_count_once(spark, tmp_path):
    docs = [(i, t, k) for i, (t, k) in enumerate(_labelled(0.0))] + [(900, " ".join(TEXTS["de"]), "fr"), (901, " ".join(TEXTS["de"]), "de"), (902, " ".join(TEXTS["de"]) + "\n\n" + " ".join(TEXTS["fr"]), "de")] * 2
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    p = spark.createDataFrame([], "ocr_id long, document_name string, full_text string")
    s = spark.createDataFrame([], "seed_id long, filename string, language string")
    got = sorted(tuple(r) for r in G.find_languages(d, s, p, document_key).collect())
    assert got == [("documents", 900, 0, "de"), ("documents", 902, 1, "de"), ("documents", 902, 2, "fr")]
    d.write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((r.row_id, r.segment_no, r.lang) for r in p5_segments(spark, str(tmp_path)).where("row_id >= 900").collect())
    assert got == [(900, 1, "de"), (901, 1, "de"), (902, 1, "de"), (902, 2, "fr")]


def test_sample_holds_every_language_wherever_it_stands(spark, monkeypatch):
    monkeypatch.setattr(G, "TRAIN_DOCUMENTS", 240)
    docs = [(f"{t} No. {i}", k) for k in ("en", "fr", "de", "th") for i in range(100 if k != "th" else 20) for t in TEXTS[k][:3]]
    got = []
    monkeypatch.setattr(G, "train", lambda labelled: got.append(labelled))
    G.fit(spark.createDataFrame(docs * 2, "text string, lang string").coalesce(1))
    n = {k: sum(c == k for _, c in got[0]) for k in ("en", "fr", "de", "th")}
    assert n == {"en": 20, "fr": 20, "de": 20, "th": 20}
    assert len(set(got[0])) == 80
    G.fit(spark.createDataFrame([], "text string, lang string"))
    assert got[1] == []
