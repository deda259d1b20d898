"""Languages of documents and of their stretches, by a string kernel.

The kernel of two texts is the share of the character n-grams (orders 1 to 3 together) that are present in both. A bounded
sample of labelled documents, drawn by language from all rows, and two fixed sentences of each language give the landmarks
of a Nyström map and the training sentences of one-versus-rest kernel ridge regression. As labels may be wrong, models of
other documents judge each sentence's label first (cross-fitting on one map). A text is scored in batches by products of
its presence matrix with the weights, into which the landmarks are folded (presence x landmarks x coefficients is one
matrix of n-grams by languages). Sentences are scored one by one; a Viterbi pass over the sentences of a text, which
charges each change of language, gives its stretches.

Cases: null, empty and blank texts, and texts without words of a language (numbers, labels, codes), have no row; label
lines and short units count with the text around them; labels are read in all usual spellings, others count as missing;
rows repeated under one id count once; without any label the fixed sentences alone are the training set.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millsheet.llm.sentences import _NUMBERS, _THAI, is_label
from millsheet.session import cut

LANGS = ("en", "fr", "de", "es", "it", "pt", "nl", "zh", "ja", "th", "hi", "ar")
#: Labelled documents in the sample, sentences of a language to train on, landmarks of a language, at most.
TRAIN_DOCUMENTS, TRAIN_SENTENCES, LANDMARKS = 6000, 1000, 40
#: Pieces of a document to train on, at most (its first), so that a few long documents don't make up a language.
TRAIN_PIECES = 12
ORDERS, SPACE, RIDGE = (1, 2, 3), 1 << 16, 0.1
#: Folds and rounds in which labels are judged; by how much a language must lead to replace a label.
FOLDS, ROUNDS, SURE = 4, 2, 0.3
#: Cost of a change of language between two sentences, in units of the scores (which lie between about 0 and 1).
CHANGE = 0.3
#: Letters that a unit must have to speak for a language.
LEAST = 6
#: Pieces shorter than this go with the next one.
SHORT = 24

#: Spellings of the languages: ISO 639-1, 639-2 and their names in the languages concerned.
_NAMES = {
    "en": "en eng english anglais englisch inglés ingles inglese inglês engels", "fr": "fr fra fre french français francais französisch francés francese francês frans",
    "de": "de deu ger german allemand deutsch alemán tedesco alemão duits", "es": "es spa spanish espagnol spanisch español espanol castellano spagnolo espanhol spaans",
    "it": "it ita italian italien italienisch italiano italiaans", "pt": "pt por portuguese portugais portugiesisch portugués português portugues portoghese portugees",
    "nl": "nl nld dut dutch néerlandais neerlandais niederländisch nederlands neerlandés olandese holandês", "zh": "zh zho chi chinese chinois chinesisch chino cinese chinês chinees 中文 汉语 漢語 普通话",
    "ja": "ja jpn jp japanese japonais japanisch japonés giapponese japonês japans 日本語", "th": "th tha thai thaï thailändisch ไทย ภาษาไทย",
    "hi": "hi hin hindi हिन्दी हिंदी", "ar": "ar ara arabic arabe arabisch árabe arabo العربية عربي",
}
_LABELS = {unicodedata.normalize("NFC", n): code for code, names in _NAMES.items() for n in names.split()}


def label_code(label: str | None) -> str | None:
    """The code that a label names, None if it is missing or names none of the languages."""
    if not label:
        return None
    s = unicodedata.normalize("NFC", label).strip().lower()
    return _LABELS.get(s) or _LABELS.get(re.split(r"[-_\s(/]", s)[0])


#: Two sentences of each language to start from (the first article of the Universal Declaration of Human Rights): fixed values.
FIRST = {
    "en": ["All human beings are born free and equal in dignity and rights.", "They are endowed with reason and conscience and should act towards one another in a spirit of brotherhood."],
    "fr": ["Tous les êtres humains naissent libres et égaux en dignité et en droits.", "Ils sont doués de raison et de conscience et doivent agir les uns envers les autres dans un esprit de fraternité."],
    "de": ["Alle Menschen sind frei und gleich an Würde und Rechten geboren.", "Sie sind mit Vernunft und Gewissen begabt und sollen einander im Geist der Brüderlichkeit begegnen."],
    "es": ["Todos los seres humanos nacen libres e iguales en dignidad y derechos.", "Dotados como están de razón y conciencia, deben comportarse fraternalmente los unos con los otros."],
    "it": ["Tutti gli esseri umani nascono liberi ed eguali in dignità e diritti.", "Essi sono dotati di ragione e di coscienza e devono agire gli uni verso gli altri in spirito di fratellanza."],
    "pt": ["Todos os seres humanos nascem livres e iguais em dignidade e em direitos.", "Dotados de razão e de consciência, devem agir uns para com os outros em espírito de fraternidade."],
    "nl": ["Alle mensen worden vrij en gelijk in waardigheid en rechten geboren.", "Zij zijn begiftigd met verstand en geweten, en behoren zich jegens elkander in een geest van broederschap te gedragen."],
    "zh": ["人人生而自由，在尊严和权利上一律平等。", "他们赋有理性和良心，并应以兄弟关系的精神相对待。"],
    "ja": ["すべての人間は、生まれながらにして自由であり、かつ、尊厳と権利とについて平等である。", "人間は、理性と良心とを授けられており、互いに同胞の精神をもって行動しなければならない。"],
    "th": ["มนุษย์ทั้งหลายเกิดมามีอิสระและเสมอภาคกันในเกียรติศักดิ์และสิทธิ", "ต่างมีเหตุผลและมโนธรรม และควรปฏิบัติต่อกันด้วยเจตนารมณ์แห่งภราดรภาพ"],
    "hi": ["सभी मनुष्यों को गौरव और अधिकारों के मामले में जन्मजात स्वतन्त्रता और समानता प्राप्त है।", "उन्हें बुद्धि और अन्तरात्मा की देन प्राप्त है और परस्पर उन्हें भाईचारे के भाव से बर्ताव करना चाहिए।"],
    "ar": ["يولد جميع الناس أحراراً متساوين في الكرامة والحقوق.", "وقد وهبوا عقلاً وضميراً وعليهم أن يعاملوا بعضهم بعضاً بروح الإخاء."],
}
#: Scripts whose letters say more than those of an alphabet.
_DENSE = re.compile("[\u2e80-\u9fff\uf900-\ufaff]")
_SCRIPT = re.compile("[\u0600-\u06ff\u0900-\u0d7f\u0e00-\u0e7f\u2e80-\u9fff\uac00-\ud7a3\uf900-\ufaff]")
_LATIN = re.compile("[A-Za-z\u00c0-\u024f]")
_CODE = re.compile(r"[A-Za-z0-9.,/°º-]*\d[A-Za-z0-9.,/°º-]*|(?<![A-Za-z])[A-Z]{2,}(?![A-Za-z])")
_OTHER = re.compile("(?:[^\\w\u0300-\u036f\u0900-\u0963\u0970-\u0dff\u0e31-\u0e3a\u0e47-\u0e4e\u0610-\u061a\u064b-\u065f]|[\\d_])+")
#: What parts the pieces of a paragraph: final punctuation before a blank, or final punctuation of scripts without blanks.
_PIECE = re.compile(r"[.!?…][\"»”’)']?\s+|[।॥。！？]+(?![”」』’])\s*")
_BLANK_LINE = re.compile(r"\n[^\S\n]*\n\s*")
#: Letters of the scripts without final punctuation, what stands between them, and what of that is no name or code in their text:
#: letters of a third script, or a run of words of which two or more are small.
_UNMARKED = re.compile(f"[{_THAI}]")
_BETWEEN = re.compile(f"[^{_THAI}]+")
_THIRD = re.compile("[\u0600-\u06ff\u0900-\u0d7f\u2e80-\u2fff\u3040-\u9fff\uac00-\ud7a3\uf900-\ufaff]")
_WORD = re.compile(r"(?<![^\W_])[^\W\d_]*[a-z\u00df-\u00f6\u00f8-\u00ff][^\W\d_]*(?![^\W_])")


class _Words(dict):
    """Words with anything but letters, without it; forgets when it gets large."""

    def __missing__(self, w: str) -> str:
        if len(self) > 50_000:
            self.clear()
        got = self[w] = _OTHER.sub(" ", _CODE.sub(" ", w)).strip().lower()
        return got


_WORDS = _Words()


def plain(text: str) -> str:
    """What of a text speaks for its language: words without codes, numbers and punctuation."""
    if not text.isascii() and (n := len(_SCRIPT.findall(text))) and n * 3 > len(_LATIN.findall(text)):
        # names and grades in a text of another script
        return _OTHER.sub(" ", f" {_LATIN.sub(' ', text)} ")
    words = [(w.lower() if len(w) == 1 or not w.isupper() else "") if w.isalpha() else _WORDS[w] for w in text.split()]
    return f" {' '.join(filter(None, words))} "


def joints(piece: str) -> list[int]:
    """Where letters of a script without final punctuation meet a run of words of another script, in order."""
    out = []
    for m in _BETWEEN.finditer(piece):
        run = m[0]
        third = _THIRD.search(run)
        words = [w for w in _WORD.finditer(run) if w.end() - w.start() > 1]
        if not third and sum(w[0].islower() for w in words) < 2:
            continue
        a = min(x.start() for x in (third, *words[:1]) if x)
        while a and not run[a - 1].isspace():  # opening marks
            a -= 1
        b = len(run)
        while b and not (run[b - 1].isspace() or run[b - 1].isalnum()):
            b -= 1
        out += [x for x in (m.start() + a, m.start() + b) if 0 < x < len(piece)]
    return out


def pieces(text: str) -> list[tuple[int, str]]:
    """(start, piece) of the pieces of a text without label lines and lines of numbers."""
    out: list[tuple[int, str]] = []
    start = 0
    unmarked = not text.isascii() and _UNMARKED.search(text) is not None
    for blank in [*_BLANK_LINE.finditer(text), None]:
        end = blank.start() if blank else len(text)
        paragraph = text[start:end]
        if ":" in paragraph or "=" in paragraph or "：" in paragraph or paragraph[:1].isdigit():
            # label lines stand at the top of a paragraph
            at = 0
            while at < len(paragraph):
                stop = paragraph.find("\n", at)
                stop = len(paragraph) if stop < 0 else stop
                line = paragraph[at:stop]
                if line.strip() and not is_label(line) and not _NUMBERS.match(line):
                    break
                at = stop + 1
            start, paragraph = start + at, paragraph[at:]
        at = 0
        for m in _PIECE.finditer(paragraph):
            # what is too short goes with what follows in its script
            if m.end() - at >= SHORT or ord(m[0][0]) > 0x900 or unmarked and _UNMARKED.match(paragraph, m.end()) and not _UNMARKED.search(paragraph, at, m.end()):
                out.append((start + at, paragraph[at : m.end()]))
                at = m.end()
        if at < len(paragraph):
            out.append((start + at, paragraph[at:]))
        start = blank.end() if blank else end
    if unmarked:
        out = [(a + x, u[x:y]) for a, u in out for cuts in ([0, *joints(u), len(u)] if _UNMARKED.search(u) else [0, len(u)],) for x, y in zip(cuts, cuts[1:])]
    return out


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, n-gram, norm of each text): the distinct hashed n-grams of every text."""
    joined = "".join(texts)
    codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(texts), dtype=np.int64), [len(t) for t in texts])
    keys = []
    h = np.zeros(len(codes), np.uint64)
    for n in range(1, max(ORDERS) + 1):
        m = len(codes) - n + 1
        if m <= 0:
            break
        h = h[:m] * np.uint64(0x9E3779B97F4A7C15) + codes[n - 1 :] + np.uint64(n)
        if n in ORDERS:
            mixed = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
            g = (mixed >> np.uint64(48)).astype(np.int64) & (SPACE - 1)
            same = owner[:m] == owner[n - 1 :]
            keys.append((owner[:m] * SPACE + g)[same])
    k = np.unique(np.concatenate(keys)) if keys else np.zeros(0, np.int64)
    who = k // SPACE
    count = np.bincount(who, minlength=len(texts))
    return who, k & (SPACE - 1), 1 / np.sqrt(np.maximum(count, 1))


def products(texts: list[str], weights: np.ndarray) -> np.ndarray:
    """Presence matrix of the texts, rows of length one, times ``weights`` (n-grams by columns)."""
    who, g, norm = grams(texts)
    out = np.zeros((len(texts), weights.shape[1]), np.float32)
    if len(who):
        starts = np.flatnonzero(np.r_[True, who[1:] != who[:-1]])
        step = max(16, 8192 // weights.shape[1])  # bounds the gathered rows
        for a in range(0, len(starts), step):
            s = starts[a : a + step]
            stop = starts[a + step] if a + step < len(starts) else len(who)
            out[who[s]] = np.add.reduceat(weights[g[s[0] : stop]], s - s[0], axis=0)
    return out * norm[:, None].astype(np.float32)


class Model:
    """Weights of the n-grams for every language."""

    def __init__(self, weights: np.ndarray) -> None:
        self.weights = weights

    def scores(self, texts: list[str], batch: int = 2000) -> np.ndarray:
        return np.concatenate([products(texts[a : a + batch], self.weights) for a in range(0, len(texts), batch)]) if texts else np.zeros((0, len(LANGS)), np.float32)


def _solve(knm: np.ndarray, kmm: np.ndarray, y: np.ndarray, weighted: bool) -> np.ndarray:
    """Coefficients of one-versus-rest kernel ridge regression on the Nyström map; ``weighted``: classes count alike, however often they occur."""
    target = (y[:, None] == np.arange(len(LANGS))).astype(np.float64)
    w = 1 / np.maximum(np.bincount(y, minlength=len(LANGS)), 1)[y] if weighted else np.ones(len(y))
    w *= len(y) / w.sum()
    left = (knm * w[:, None]).T @ knm + RIDGE * len(y) / len(kmm) * (kmm + 1e-6 * np.eye(len(kmm)))
    return np.linalg.solve(left, (knm * w[:, None]).T @ target)


def train(labelled: list[tuple[str, str]]) -> Model:
    """The model from (text, language) of labelled documents, whose labels may be wrong.

    A piece's label is judged by models of the documents of other folds, in which every piece counts alike, so that the
    wrong labels of a rare language weigh no more than any others: what they contradict gets the language they are sure
    of, or is left out.
    """
    texts = [plain(t) for k in LANGS for t in FIRST[k]]
    y = [i for i, k in enumerate(LANGS) for _ in FIRST[k]]
    fold = [-1] * len(texts)  # of no fold: in every model
    given = len(texts)
    count = dict.fromkeys(LANGS, 0)
    # in the order of a hash: any other order may put texts of one kind, such as wrongly labelled ones, first
    for h, text, lang in sorted((xxhash.xxh64_intdigest(t), t, k) for t, k in labelled):
        own = [p for _, u in pieces(text)[:TRAIN_PIECES] if len(p := plain(u)) > (6 if _DENSE.search(p) else 15)] if count[lang] < TRAIN_SENTENCES else []
        count[lang] += len(own)
        texts += own
        y += [LANGS.index(lang)] * len(own)
        fold += [h % FOLDS] * len(own)
    y, fold = np.array(y), np.array(fold)
    marks = sorted({*range(given), *(i for k in range(len(LANGS)) for i in given + np.flatnonzero(y[given:] == k)[:LANDMARKS])})
    land = np.zeros((SPACE, len(marks)), np.float32)
    who, g, norm = grams([texts[i] for i in marks])
    land[g, who] = norm[who]
    knm = np.concatenate([products(texts[a : a + 500], land) for a in range(0, len(texts), 500)]).astype(np.float64)
    kmm = knm[marks]
    label, keep = y.copy(), np.ones(len(y), bool)
    for _ in range(ROUNDS):
        for f in range(FOLDS):
            held, rest = fold == f, (fold != f) & keep
            s = knm[held] @ _solve(knm[rest], kmm, label[rest], False)
            top = s.argmax(1)
            margin = np.diff(np.partition(s, -2, 1)[:, -2:])[:, 0] if len(s) else np.zeros(0)
            label[held] = np.where(margin > SURE, top, y[held])
            keep[held] = (top == label[held]) | (margin > SURE)
    alpha = _solve(knm[keep], kmm, label[keep], True)
    return Model((land @ alpha.astype(np.float32)).astype(np.float32))


def fit(documents: DataFrame, label: str = "lang") -> Model:
    """The model, trained on the documents (text, label) of each known label whose texts have the smallest hashes, a bounded number."""
    per = TRAIN_DOCUMENTS // len(LANGS)
    rows = documents.where(F.col("text").isNotNull() & F.col(label).isNotNull()).withColumn("h", F.xxhash64("text"))
    # hashes alone are ranked, a bounded number of each label and part is shuffled
    ranked = rows.select(_codes(label).alias("code"), "h").where("code is not null").distinct().withColumn("k", F.row_number().over(Window.partitionBy("code").orderBy("h")))
    sample = rows.select("text", "h").join(F.broadcast(ranked.where(F.col("k") <= per).select("code", "h")), "h")
    return train(sorted((r[0], r[1]) for r in sample.select("text", "code").distinct().collect()))


def stretches(scores: np.ndarray, lengths: np.ndarray) -> list[tuple[int, int, float]]:
    """(first unit, language, confidence) of the maximal stretches that Viterbi decoding gives."""
    n, k = scores.shape
    e = scores * np.minimum(1.0, lengths / 25.0)[:, None]
    best = e[0].astype(np.float64)
    back = np.zeros((n, k), np.int64)
    for i in range(1, n):
        top = int(best.argmax())
        stay = best >= best[top] - CHANGE
        back[i] = np.where(stay, np.arange(k), top)
        best = np.where(stay, best, best[top] - CHANGE) + e[i]
    path = np.zeros(n, np.int64)
    path[-1] = int(best.argmax())
    for i in range(n - 1, 0, -1):
        path[i - 1] = back[i][path[i]]
    starts = np.flatnonzero(np.r_[True, path[1:] != path[:-1]])
    out = []
    for a, b in zip(starts, [*starts[1:], n]):
        mean = np.average(scores[a:b], axis=0, weights=lengths[a:b])
        top = int(path[a])
        rest = np.delete(mean, top).max() if k > 1 else 0.0
        out.append((int(a), top, float(np.clip(0.5 + (mean[top] - rest) / 2, 0, 1))))
    return out


class Reader:
    """Reads the languages of texts in batches; keeps the scores of units it has met."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.known: dict[str, np.ndarray] = {}

    def read(self, texts: list[str | None]) -> list[list[tuple[int, int, str, float]]]:
        """Of every text its stretches: (start, end, language, confidence)."""
        units: list[list[tuple[int, str]]] = []
        new: dict[str, None] = {}
        for t in texts:
            own = []
            for a, u in pieces(t or ""):
                p = plain(u)
                if len(p) - 2 >= LEAST or len(p) > 4 and _DENSE.search(p):
                    own.append((a, p))
                    if p not in self.known:
                        new[p] = None
            units.append(own)
        fresh = list(new)
        for p, s in zip(fresh, self.model.scores(fresh)):
            self.known[p] = s
        out = []
        for t, own in zip(texts, units):
            if not own:
                out.append([])
                continue
            s = np.array([self.known[p] for _, p in own])
            top = s.argmax(1)
            if (top == top[0]).all():  # nothing to decide
                n = np.array([len(p) for _, p in own], float)
                mean = n @ s / n.sum()
                k = int(top[0])
                out.append([(0, len(t or ""), LANGS[k], float(np.clip(0.5 + (mean[k] - np.delete(mean, k).max()) / 2, 0, 1)))])
                continue
            n = np.array([len(p) * (3 if _DENSE.search(p) else 1) for _, p in own], float)
            cuts = stretches(s, n)
            bounds = [0, *(own[a][0] for a, _, _ in cuts[1:]), len(t or "")]
            out.append([(bounds[i], bounds[i + 1], LANGS[k], c) for i, (_, k, c) in enumerate(cuts)])
        if len(self.known) > 100_000:
            self.known.clear()
        return out


READ = "row_id long, segment_no int, start_pos int, end_pos int, lang string, confidence double"


def read_languages(texts: DataFrame, model: Model) -> DataFrame:
    """Every stretch of every text (row_id, text): segment_no from 1, positions, language and confidence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("row_id", pa.int64()), ("segment_no", pa.int32()), ("start_pos", pa.int32()), ("end_pos", pa.int32()), ("lang", pa.string()), ("confidence", pa.float64())])
        reader = Reader(model)
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                b = whole.slice(at, 500)
                ids = b.column("row_id").to_pylist()
                rows = [(i, k, *x) for i, got in zip(ids, reader.read(b.column("text").to_pylist())) for k, x in enumerate(got, 1)]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)

    return texts.where("row_id is not null and text is not null").select("row_id", "text").mapInArrow(run, READ)


def _codes(column: str):  # noqa: ANN202
    """Expression of ``label_code``, evaluated in the JVM; composed and decomposed letters are both known."""
    s = F.lower(F.trim(F.col(column)))
    known = F.create_map(*[F.lit(x) for n, c in sorted({(unicodedata.normalize(f, n), c) for n, c in _LABELS.items() for f in ("NFC", "NFD")}) for x in (n, c)])
    return F.coalesce(F.try_element_at(known, s), F.try_element_at(known, F.element_at(F.split(s, "[-_\\s(/]"), 1)))


def find_languages(documents: DataFrame, seeds: DataFrame, pages: DataFrame, key) -> DataFrame:  # noqa: ANN001
    """Stretches of mixed texts, and languages of texts whose label is missing or wrong (see the module); ``key`` unifies document names."""
    model = fit(documents)
    # read once, used by several branches below
    doc = cut(read_languages(documents.select(F.col("doc_id").alias("row_id"), "text"), model).select("row_id", "segment_no", "lang").distinct())
    page = cut(read_languages(pages.select(F.col("ocr_id").alias("row_id"), F.col("full_text").alias("text")), model).select("row_id", "segment_no", "lang").distinct())
    d = doc.groupBy("row_id").agg(F.array_sort(F.collect_list(F.struct("segment_no", "lang"))).alias("s"))
    labels = documents.select(F.col("doc_id").alias("row_id"), _codes("lang").alias("code")).dropDuplicates(["row_id"])
    d = d.join(labels, "row_id")
    one = d.where((F.size("s") == 1) & ~F.coalesce(F.col("code") == F.col("s")[0]["lang"], F.lit(False))).select(F.lit("documents").alias("source_table"), "row_id", F.lit(0).alias("segment_no"), F.col("s")[0]["lang"].alias("lang"))
    many = d.where(F.size("s") > 1).select(F.lit("documents").alias("source_table"), "row_id", F.explode("s").alias("x")).select("source_table", "row_id", "x.segment_no", "x.lang")
    p = page.groupBy("row_id").agg(F.array_sort(F.collect_list(F.struct("segment_no", "lang"))).alias("s"))
    mixed = p.where(F.size("s") > 1).select(F.lit("ocr_result").alias("source_table"), "row_id", F.explode("s").alias("x")).select("source_table", "row_id", "x.segment_no", "x.lang")
    of_file = pages.select(F.col("ocr_id").alias("row_id"), key(F.col("document_name")).alias("file")).where("file is not null").distinct().join(page, "row_id")
    of_file = of_file.groupBy("file").agg(F.collect_set("lang").alias("langs")).where(F.size("langs") == 1).select("file", F.col("langs")[0].alias("lang"))
    s = seeds.select(F.col("seed_id").alias("row_id"), key(F.col("filename")).alias("file"), _codes("language").alias("code")).distinct().join(of_file, "file")
    wrong = s.where(~F.coalesce(F.col("code") == F.col("lang"), F.lit(False))).select(F.lit("seed_record").alias("source_table"), "row_id", F.lit(0).alias("segment_no"), "lang")
    return one.unionByName(many).unionByName(mixed).unionByName(wrong)
