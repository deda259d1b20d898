"""Sentence boundaries across languages and scripts.

Characters are tagged as boundary or inside by a linear-chain model and Viterbi decoding. Only characters that may end a
sentence can be boundaries: final punctuation with its closing marks, and, in scripts that end sentences by a blank
alone, blanks. The emission of a candidate is the sum of trained weights of features of what stands before it (word, shape,
length, membership of a list of abbreviations), of its marks, of what follows (class of the next letter, next word, gap)
and of pairs of these. Transitions are trained as well: what the distance from the boundary before it says of a candidate.

No text has marked sentences, so the model is trained on a bounded sample by hard EM. What is known to begin with: the
ends and beginnings of paragraphs are ends and beginnings of sentences, and a mark before a small letter, a digit without
a blank or a comma is mostly none. Logistic regression of the left sides on the former against the latter gives a first
guess of the ends, right sides after unlikely ends give the non-beginnings; then all candidates are decoded and the weights
of all features fitted to the result, several times. For scripts without final punctuation paragraphs are stripped of
punctuation and joined: their joints are known boundaries, the other blanks are unlabelled, and rounds of decoding and
counting give the weights of what precedes and follows a boundary.

Label lines and lines of bare numbers are units of their own, blank lines end a sentence, line breaks don't. What is
quoted belongs to the sentence that carries it, so marks inside a quotation are no candidates.

Cases: null and empty texts, and texts of blanks only, have no row; very long texts are read whole; positions are code
points; rows repeated under one id count once, of different texts the first; extra columns are dropped; without texts to train on the model starts from
``FIRST`` alone.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millsheet.session import cut

#: Texts that the model is trained on, at most: with final punctuation, and in scripts without.
TRAIN_DOCUMENTS = 3000
#: Rounds of decoding and fitting.
ROUNDS = 3
#: By how much the first guess favours boundaries.
MARGIN = 1.0
#: How much less usual than others a word may be at the ends of paragraphs that still ends sentences whatever follows (log odds).
PLAIN = -1.2
#: Steps of a fit; precision of the weights' prior, which keeps rare features small, in later fits and in those of the first guess.
STEPS, DECAY, FIRST_DECAY = 100, 0.5, 1.0
#: How many times that precision is for features of what follows alone.
RIGHT_DECAY = 10.0

#: Abbreviations that a sentence mostly goes on after: titles, references, numbers, examples (without points, lower case). A list is one feature among others.
INNER = frozenset(
    "m mme mlle mr mrs ms dhr mevr dr prof sr sra ing eng hr fr st nos nr no n num nº fig figs abb abs bl tab pos art p pp s v vgl cf cfr ref réf rif vs bldg bât bat edif ed approx env ca aprox ungef ggf bzw"
    " z b d h i e g ex ej es c a c-à-d cad à eg ie zb dh bijv resp max min mind tel fax col coll inkl incl excl exkl evtl sog ds rev kap chap sect nom dim temp op cit o.g u.a pr par".split()
)
#: Abbreviations that may also end a sentence.
ENDING = frozenset("etc usw ecc enz ff ltd inc corp co sa sas sarl spa srl gmbh g.m.b.h s.a s.a.s s.a.r.l s.p.a s.r.l bv nv a.m p.m am pm uhr jr".split())

#: Paragraphs to start from: fixed examples of sentences in scripts and layouts that a sample may lack.
FIRST = [
    "The plate was cut. It was shipped. Was it tested? Yes!", "La tôle a été coupée. Elle est partie.", "Das Blech wurde geschnitten. Es wurde geprüft.", "Se cortó la chapa. ¿Por qué? ¡Alto!",
    "鋼板を切断した。検査した。", "钢板已切割。为什么？", "प्लेट काटी गई। जाँच हुई।", "تم قطع اللوح. هل فُحص؟ نعم.",
    "See fig. 3 and no. 4, e.g. the cover, at 3.6 bar.", "Selon M. Durand, cf. réf. 12, env. 5.10 m, p. ex. ici.", "Laut Dr. Weber, z. B. ca. 9 mm, vgl. Abb. 3.",
]

_FINAL = ".!?…।॥؟。！？｡"
_CLOSE = "\"'”“’»」』)）]】›"
_PARAGRAPH = re.compile(r"(?:\r\n?|\n)[^\S\n]*(?:(?:\r\n?|\n)[^\S\n]*)+|[\f\v ]\s*")
_LABEL = re.compile(r"\s*([^\s:=：][^:=：\n]*?)\s*[:=：]\s*(\S.*?)\s*$")
_NUMBERS = re.compile(r"[\s\d./,;|+–—-]*\d[\s\d./,;|+–—-]*$")
_BESIDE_DIGITS = "./,;|+–—-"
_QUOTE = re.compile(r"«[^«»]*»|„[^„“”]*[“”]|“[^“”]*”|「[^「」]*」|『[^『』]*』|(?<![^\s(\[:,])\"(?=\S)[^\"]*\"|(?<![^\s(\[:,])['‘](?=[^\W\d_])[^'’]*(?:[’'](?=[^\W\d_])[^'’]*)*[.!?]['’](?!\w)")
_THAI = "฀-๿຀-໿ក-៿က-႟"
_IS_THAI = re.compile(f"[{_THAI}]")
# a point between digits is part of a number
_MARKS = rf"[{re.escape(_FINAL)}](?<!\d\.(?=\d))[{re.escape(_FINAL)}]*(?:[^\S\n]?»|[{re.escape(_CLOSE)}])*"
_CANDIDATE = re.compile(rf"{_MARKS}|(?<=\S)\s+(?=\S)")
_MARK = re.compile(_MARKS)
_MARK_GAP = re.compile(rf"({_MARKS})(\s*)")
_CJK = re.compile(r"[぀-ヿ㐀-䶿一-鿿豈-﫿]")
_HAS_QUOTE = re.compile("[«„“「『\"'‘]")
_LATIN_START = re.compile(r"[¿¡«„“\"(]?\s?[A-ZÀ-ÖØ-Þ](?:['’][A-Za-zÀ-ÿ]|[a-zà-öø-ÿ]+)[\w'’-]*[\s,]+(?:[a-zà-öø-ÿ]|[A-ZÀ-Þ][a-zà-öø-ÿ])")
_OPEN = "\"'«„“「『‘(["
_LAST = re.compile("(?:[^\\W_]|[\u0300-\u036f\u064b-\u065f\u0900-\u0963\u0970-\u0dff])+$")


def _near(word: str, words: frozenset[str]) -> bool:
    """Whether a word of three or more letters is one of ``words`` but for a misread letter."""
    return len(word) > 2 and any(len(w) == len(word) and sum(a != b for a, b in zip(w, word)) == 1 for w in words)


def _shape(word: str) -> str:
    """A word's letters by class, runs as one."""
    out = ""
    for ch in word:
        k = "A" if ch.isupper() else "a" if ch.islower() else "9" if ch.isdigit() else "x" if ch.isalpha() else ch
        if not out or out[-1] != k:
            out += k
    return out[:8]


def _script(ch: str) -> str:
    return "l" if ch < "\u0590" else "r" if ch < "\u0900" else "d" if ch < "\u0e00" else "t" if _IS_THAI.match(ch) else "c" if _CJK.match(ch) else "o"


def before(token: str) -> list[str]:
    """Features of what stands before a mark; the first is its class."""
    word = token.lstrip(_OPEN)
    if "'" in word or "’" in word:
        word = re.split("['’]", word)[-1]
    low = word.lower()
    found = _LAST.search(low)
    last = found[0] if found else ""
    if not last:
        return ["L-" + low[-1:], "s" + _shape(low[-4:])]
    script = _script(last[-1])
    if script == "c" or script == "t":
        return ["L" + script]
    kind = "i" if low in INNER or low.replace(".", "") in INNER or "." in low and last in INNER else "e" if low in ENDING or low.replace(".", "") in ENDING else "f" if _near(last, ENDING) else "n" if _near(last, INNER) else "-"
    size = min(len(last), 6)
    shape = _shape(word[-12:])
    digit = last[-1].isdigit()
    out = [f"L{script}{kind}{'9' if digit else size}", f"s{shape}", f"z{size}{last.isdigit()}", f"k{kind}", f"S{script}{size if script != 'l' else ''}"]
    if not digit and len(last) < 7:  # abbreviations are short
        out += [f"w{low[-12:]}", f"v{last}"]
    return out


def after(token: str) -> list[str]:
    """Features of what follows a mark; the first is its class."""
    first = token[0]
    word = token.lstrip(_OPEN + "¿¡")
    opened = first in _OPEN or first in "¿¡"
    if not word:
        return ["R" + ("(" if opened else ")")]
    ch = word[0]
    if not ch.isalnum():
        return [f"R{'(' if opened else ''}{ch}"]
    script = _script(ch)
    if ch.isdigit():
        return [f"R{'(' if opened else ''}9", f"q{_shape(word)[:4]}"]
    if script != "l":
        return [f"R{'(' if opened else ''}{script}", f"1{word[:1]}", f"2{word[:2]}"]
    letters = re.match(r"[^\W\d_]+", word)[0]
    kind = "u" if ch.isupper() and letters[1:2].islower() else "U" if ch.isupper() else "a"
    points = "." if word[len(letters) : len(letters) + 1] == "." else ""
    low = letters.lower()
    return [f"R{'(' if opened else ''}{kind}{min(len(letters), 3)}{points}", f"r{kind}", f"y{low[:8]}{points}", f"x{_shape(word)[:4]}"]


def features(key: tuple[str, str, str, str]) -> list[str]:
    """Features of a candidate: (word before, marks, gap, word after)."""
    left, marks, gap, right = key
    a, z = before(left), after(right)
    bare = marks.rstrip(_CLOSE + " ")
    m = "." if bare == "." else ".." if set(bare) == {"."} else bare[:1]
    # after a quotation other things follow
    g = ("»" if len(bare) < len(marks) else "") + ("1" if gap else "0")
    return ["", *a, f"m{m}{g[:-1]}", *z, f"g{g}{z[0]}", f"{a[0]}|{z[0]}|{g}", f"{a[0]}|{g}", f"m{m}|{g}|{z[0]}", f"m{m}|{a[0]}", *(f"{x}|{g}|{z[0][:2]}" for x in a[1:] if x[0] in "wk")]


def _sure_inside(key: tuple[str, str, str, str], begins: frozenset[str]) -> bool:
    """Marks that mostly are no boundary: before a small letter, before a digit or a small letter without a blank, before commas and closing marks; not before words that paragraphs begin with."""
    _, marks, gap, right = key
    ch = right[0]
    if gap and right in begins:
        return False
    return marks[0] == "." and (ch.islower() or not gap and ch.isdigit()) or ch in ",;:%)]"


class _Fit:
    """Logistic regression on sparse rows of features."""

    def __init__(self) -> None:
        self.index: dict[str, int] = {}

    def rows(self, rows: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """(row, feature) of every feature that occurs."""
        index = self.index
        at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        return at, np.array([index.setdefault(f, len(index)) for r in rows for f in r], np.int64)

    def fit(self, rows: list[list[str]], y: np.ndarray, weight: np.ndarray, decay: float = DECAY) -> np.ndarray:
        at, f = self.rows(rows)
        w, g2 = np.zeros(len(self.index)), np.zeros(len(self.index))
        total = weight.sum()
        # what stands before a mark is to explain it rather than the letter after it, which is as often small by mistake
        decay = np.array([decay * (RIGHT_DECAY if f[:1] in "Rrxgq" else 1.0) for f in self.index])
        for _ in range(STEPS):
            s = np.bincount(at, w[f], len(rows))
            d = (1 / (1 + np.exp(-s)) - y) * weight / total
            g = np.bincount(f, d[at], len(w)) + decay / total * w
            g2 += g * g
            w -= 0.5 * g / (np.sqrt(g2) + 1e-9)
        return w


class Tagger:
    """The linear-chain model: weights of features and transitions, and the trained contexts of blanks in unpunctuated scripts."""

    def __init__(self, weights: dict[str, float] | None = None, transitions: list[float] | None = None, before: dict[str, float] | None = None, after: dict[str, float] | None = None) -> None:
        self.weights, self.transitions = weights or {}, transitions or [-8.0, 0.0, 0.0, 0.0]
        self.before, self.after = before or {}, after or {}
        self.trained = bool(self.after)
        self.memo: dict[tuple[str, str, str, str], float] = {}

    def emission(self, key: tuple[str, str, str, str]) -> float:
        """Log odds of a boundary at a mark, without its neighbours."""
        e = self.memo.get(key)
        if e is None:
            if len(self.memo) > 200_000:
                self.memo.clear()
            w = self.weights
            e = self.memo[key] = sum(w[f] for f in features(key) if f in w)
        return e

    # contexts of a blank in an unpunctuated script

    @staticmethod
    def left(text: str, at: int) -> list[str]:
        s = re.sub(r"\d+", "0", text[max(0, at - 24) : at])
        s = re.sub(r"[A-Za-z]+", "A", s)
        return [s[-n:] for n in (2, 4, 6)]

    @staticmethod
    def right(text: str, at: int) -> list[str]:
        s = re.sub(r"\d+", "0", text[at : at + 24])
        s = re.sub(r"[A-Za-z]+", "A", s)
        return [s[:n] for n in (1, 2, 4, 7)]

    def blank(self, text: str, a: int, b: int) -> float:
        """Emission of the blank at a..b for "boundary", against "inside", in an unpunctuated script."""
        follow = text[b]
        if not _IS_THAI.match(follow):
            if _LATIN_START.match(text, b) or _CJK.match(follow) or re.match(r"[ऀ-ॿ؀-ۿ¿¡]", follow):
                return 4.0
            return -4.0
        score = 0.5 if _IS_THAI.match(text[a - 1]) else -0.5
        if not self.trained:
            return score
        for keys, weights in ((self.left(text, a), self.before), (self.right(text, b), self.after)):
            score += next((weights[k] for k in reversed(keys) if k in weights), -1.0)
        return score

    def decode(self, scores: list[float], distances: list[int]) -> list[bool]:
        """Viterbi over the candidates; ``distances``: of each from the candidate before it (letters between, by size)."""
        inside, boundary = 0.0, -math.inf
        back: list[tuple[bool, bool]] = []
        jump = self.transitions
        for e, d in zip(scores, distances):
            i_prev = boundary > inside
            top = boundary if i_prev else inside
            from_b = boundary + jump[d]
            j_prev = from_b > inside
            back.append((i_prev, j_prev))
            inside, boundary = top, (from_b if j_prev else inside) + e
        state = boundary > inside
        tags = []
        for i_prev, j_prev in reversed(back):
            tags.append(state)
            state = j_prev if state else i_prev
        return tags[::-1]

    def candidates(self, text: str, start: int, end: int) -> list[tuple[int, int, tuple[str, str, str, str] | float]]:
        """(end of the sentence, start of the next, key of a mark or score of a blank) of what may be a boundary in text[start:end]."""
        quotes = [(m.start(), m.end()) for m in _QUOTE.finditer(text, start, end)] if _HAS_QUOTE.search(text, start, end) else []
        # blanks end sentences only in scripts without final punctuation
        if not text.isascii() and _IS_THAI.search(text, start, end):
            return self._with_blanks(text, start, end, quotes)
        out: list[tuple[int, int, tuple[str, str, str, str] | float]] = []
        q = 0
        for m in _MARK_GAP.finditer(text, start, end):
            a, b, c = m.start(), m.end(1), m.end()
            if quotes:
                while q < len(quotes) and quotes[q][1] <= a:
                    q += 1
                if q < len(quotes) and quotes[q][0] < a < quotes[q][1]:
                    if b < quotes[q][1]:
                        continue  # inside a quotation that goes on
                    if b > quotes[q][1]:
                        b = c = quotes[q][1]
            if c >= end:
                break
            # a blank before a mark ends the word before it, too
            left = text[a - 24 if a - start > 24 else start : a].rsplit(None, 1)
            out.append((b, c, (left[-1] if left else "", text[a:b], " " if c > b else "", text[c : c + 16 if end - c > 16 else end].split(None, 1)[0])))
        return out

    def _with_blanks(self, text: str, start: int, end: int, quotes: list[tuple[int, int]]) -> list[tuple[int, int, tuple[str, str, str, str] | float]]:
        """Candidates where a script without final punctuation occurs: its blanks, and the marks of others."""
        out: list[tuple[int, int, tuple[str, str, str, str] | float]] = []
        q = 0
        thai = False
        at = start
        for m in _CANDIDATE.finditer(text, start, end):
            a, b = m.span()
            thai = thai or _IS_THAI.search(text, at, a) is not None
            at = b
            while q < len(quotes) and quotes[q][1] <= a:
                q += 1
            if q < len(quotes) and quotes[q][0] < a < quotes[q][1]:
                if text[a].isspace() or b < quotes[q][1]:
                    continue
                b = quotes[q][1]
            if text[a].isspace():
                if not thai:
                    continue
                # after final punctuation the mark has already been judged
                if text[a - 1] in _FINAL and not _IS_THAI.match(text[max(start, a - 2)]):
                    continue
                if not _IS_THAI.search(text, max(start, a - 30), a) and not _IS_THAI.match(text[b]):
                    thai = False
                    continue
                out.append((a, b, self.blank(text, a, b)))
                continue
            if _IS_THAI.match(text[a - 1] if a > start else " ") and text[a] == ".":
                continue  # the blank after it is judged
            c = b
            while c < end and text[c].isspace():
                c += 1
            if c >= end:
                break
            left = text[max(start, a - 24) : a].rsplit(None, 1)
            out.append((b, c, (left[-1] if left else "", text[a:b], " " if c > b else "", text[c : min(end, c + 16)].split(None, 1)[0])))
            thai = thai and _IS_THAI.match(text[c]) is not None
        return out

    def cut(self, text: str, start: int, end: int) -> list[tuple[int, int]]:
        """Sentences of text[start:end], a piece without blank lines and labels."""
        found = self.candidates(text, start, end)
        if not found:
            return [(start, end)]
        scores = [x if isinstance(x, float) else self.emission(x) for _, _, x in found]
        tags = self.decode(scores, distances(text, start, found))
        out, s = [], start
        for (stop, begin, _), t in zip(found, tags):
            if t:
                out.append((s, stop))
                s = begin
        out.append((s, end))
        return out

    def units(self, text: str) -> list[tuple[int, int]]:
        """(start, end) of every unit of a text, in order."""
        out: list[tuple[int, int]] = []
        at = 0
        for m in [*_PARAGRAPH.finditer(text), None]:
            stop = m.start() if m else len(text)
            out += self._paragraph(text, at, stop)
            at = m.end() if m else stop
        trimmed = []
        for a, b in out:
            if text[a].isspace():
                a += b - a - len(text[a:b].lstrip())
            if a < b and text[b - 1].isspace():
                b = a + len(text[a:b].rstrip())
            if a < b:
                trimmed.append((a, b))
        return trimmed

    def _paragraph(self, text: str, start: int, end: int) -> list[tuple[int, int]]:
        out: list[tuple[int, int]] = []
        a, piece, head = start, start, True
        while a < end:
            b = text.find("\n", a, end)
            b = end if b < 0 else b
            line = text[a:b]
            first = line.lstrip()[:1]
            if first:
                numbers = (first.isdigit() or first in _BESIDE_DIGITS) and _NUMBERS.match(line) and (head or len(re.findall(r"\d+", line)) > 2)
                if numbers or head and is_label(line):
                    if text[piece:a].strip():
                        out += self.cut(text, piece, a)
                    out.append((a, b))
                    piece = b
                else:
                    head = False
            a = b + 1
        if text[piece:end].strip():
            while piece < end and text[piece].isspace():
                piece += 1
            while end > piece and text[end - 1].isspace():
                end -= 1
            out += self.cut(text, piece, end)
        return out


def is_label(line: str) -> bool:
    """Whether a whole line is ``name : value``."""
    if ":" not in line and "=" not in line and "：" not in line:
        return False
    m = _LABEL.match(line)
    if not m:
        return False
    name, value = m[1], m[2]
    if len(name.split()) > 5 or value[0] in "\"'«„“「『‘" or re.search(r"[!?؟。！？।]", name) or re.search(r"[.!?。！？।؟]\s", value) or re.search(r"\d[.,]\d", name):
        return False
    return not (re.search(r"[!?؟。！？।]$", value) or value.endswith(".") and len(value.split()) > 6)


def distances(text: str, start: int, found: list) -> list[int]:
    """Of every candidate the size of what stands between it and the one before: no letters, one or two, a word, more."""
    out, last = [], start
    for stop, begin, _ in found:
        n = stop - last
        out.append(3 if n > 11 else 2 if n > 4 else 1 if any(map(str.isalnum, text[last:stop])) else 0)
        last = begin
    return out


def _pieces(texts: list[str]) -> Iterator[tuple[str, int, int]]:
    """(text, start, end) of the pieces of the texts that are no label lines."""
    held: list[tuple[int, int]] = []

    class _Collect(Tagger):
        def cut(self, text: str, start: int, end: int) -> list[tuple[int, int]]:
            held.append((start, end))
            return [(start, end)]

    collect = _Collect()
    for t in texts:
        held.clear()
        collect.units(t)
        yield from ((t, a, b) for a, b in held)


def train_marks(texts: list[str]) -> tuple[dict[str, float], list[float]]:
    """Weights of the features of marks and transitions, by hard EM."""
    plain = Tagger()
    pieces: list[tuple[list[tuple[str, str, str, str]], list[int]]] = []
    ends: list[list[str]] = []
    starts: list[list[str]] = []
    first_words: Counter = Counter()
    for text, a, b in _pieces([*FIRST, *texts]):
        while a < b and text[a].isspace():
            a += 1
        while b > a and text[b - 1].isspace():
            b -= 1
        if a == b:
            continue
        found = [x for x in plain.candidates(text, a, b) if not isinstance(x[2], float)]
        pieces.append(([x[2] for x in found], distances(text, a, found)))
        first_words[text[a : a + 16].split(None, 1)[0]] += 1
        starts.append(after(text[a : a + 16].split(None, 1)[0]))
        *_, m = None, *_MARK.finditer(text, max(a, b - 8), b)
        if m and m.end() == b:
            words = text[max(a, m.start() - 24) : m.start()].split()
            key = (words[-1] if words else "", m[0], " ", "X")
            ends.append([f for f in features(key) if "|" not in f and f[:1] not in "Rryxqg12"])
    begins = frozenset(w for w, c in first_words.items() if c > 2)
    keys = Counter(k for ks, _ in pieces for k in ks)
    if not keys:
        return {}, Tagger().transitions
    rows = {k: features(k) for k in keys}
    n = np.array([keys[k] for k in keys], float)
    inside = np.array([_sure_inside(k, begins) for k in keys])
    # first guess: what is as usual at the ends (beginnings) of paragraphs as at marks is one of sentences
    guesses = []
    for known, of in ((ends, lambda k: [f for f in rows[k] if "|" not in f and f[:1] not in "Rryxqg12"]), (starts, lambda k: after(k[3]))):
        model = _Fit()
        x = known + [of(k) for k in keys]
        w = model.fit(x, np.r_[np.ones(len(known)), np.zeros(len(keys))], np.r_[np.ones(len(known)), n], FIRST_DECAY)
        at, f = model.rows([of(k) for k in keys])
        guesses.append(np.bincount(at, w[f], len(keys)) - math.log((len(known) + 1) / (n[~inside].sum() + 1)))
    left, right = guesses
    # after a word that is as usual at ends as any other, a mark before a blank is an end even if a small letter follows; but not
    # after what may be a misread abbreviation
    plain_word = (left > PLAIN) & [bool(k[2]) and k[1][-1] in _FINAL and "kf" not in rows[k] for k in keys] & (inside & [k[3][0].isalpha() for k in keys] | [k[1][0] != "." for k in keys])
    tagger = Tagger()
    tagger.memo = dict(zip(keys, np.where(plain_word, np.maximum(left + right + MARGIN, MARGIN), np.where(inside, np.minimum(left + right, 0.0) - 4.0, left + right + MARGIN)).tolist()))
    weights: dict[str, float] = {}
    jump = tagger.transitions
    for _ in range(ROUNDS):
        yes: Counter = Counter()
        pairs = np.full((2, 4, 2), 1.0)
        for ks, ds in pieces:
            before_ = False
            for k, d, t in zip(ks, ds, tagger.decode([tagger.emission(k) for k in ks], ds)):
                yes[k] += t
                pairs[int(before_), d, int(t)] += 1
                before_ = t
        # what the distance from a boundary adds to a candidate's log odds
        odds = np.log(pairs[:, :, 1] / pairs[:, :, 0])
        everywhere = np.log(pairs.sum(0)[:, 1] / pairs.sum(0)[:, 0])
        jump = np.clip(odds[1] - everywhere, -8.0, 8.0).tolist()
        model = _Fit()
        x = [rows[k] for k in keys] + ends + starts
        y = np.r_[[yes[k] / keys[k] for k in keys], np.ones(len(ends) + len(starts))]
        w = model.fit(x, y, np.r_[n, np.full(len(ends) + len(starts), 0.2)])
        weights = {f: v for f, v in zip(model.index, w.tolist()) if abs(v) > 1e-3}
        tagger = Tagger(weights, jump)
    return weights, jump


def train_blanks(texts: list[str]) -> tuple[dict[str, float], dict[str, float]]:
    """Weights of the contexts before and after blanks, from texts in unpunctuated scripts."""
    joined: list[tuple[str, set[int]]] = []
    plain = Tagger()
    for t in texts:
        parts, known, size = [], set(), 0
        for p in _PARAGRAPH.split(t):
            lines = [x for x in p.split("\n") if not is_label(x) and not _NUMBERS.match(x)]
            s = re.sub(r"[!?…]+|\.(?=\s|$)", "", re.sub(r"\s+", " ", " ".join(lines)).strip())
            if len(_IS_THAI.findall(s)) * 2 < len(s.replace(" ", "")):
                continue
            if parts:
                known.add(size)
                size += 1
            parts.append(s)
            size += len(s)
        if parts:
            joined.append((" ".join(parts), known))
    tagger = plain
    for _ in range(ROUNDS):
        yes_l, yes_r, all_l, all_r = Counter(), Counter(), Counter(), Counter()
        n_yes = n_all = 0
        for s, known in joined:
            # what follows and precedes the whole text is a boundary as well
            for key in Tagger.right(s, 0):
                yes_r[key] += 1
            for key in Tagger.left(s, len(s)):
                yes_l[key] += 1
            n_yes += 1
            at = [m.start() for m in re.finditer(" ", s)]
            if tagger.trained:
                tags = tagger.decode([9.0 if a in known else tagger.blank(s, a, a + 1) for a in at], [3] * len(at))
            else:
                tags = [a in known for a in at]
            for a, t in zip(at, tags):
                n_all += 1
                left, right = Tagger.left(s, a), Tagger.right(s, a + 1)
                # before the first decoding all blanks but the joints count as inside
                for key in left:
                    all_l[key] += not t
                for key in right:
                    all_r[key] += not t
                if t:
                    n_yes += 1
                    for key in left:
                        yes_l[key] += 1
                    for key in right:
                        yes_r[key] += 1
        n_no = max(1, n_all - n_yes)
        weigh = lambda y, n: {k: max(-4.0, min(4.0, math.log((y[k] + 0.1) / (n_yes + 1)) - math.log((n[k] + 0.1) / (n_no + 1)) + (0.7 if not tagger.trained and y[k] else 0.0))) for k in set(y) | set(n)}  # noqa: E731, B023
        tagger = Tagger(None, None, weigh(yes_l, all_l), weigh(yes_r, all_r)) if joined else plain
    return tagger.before, tagger.after


def train(texts: list[str]) -> Tagger:
    """A tagger trained on texts without marked sentences."""
    # what is written without final punctuation tells nothing of marks
    unmarked = [t for t in texts if _IS_THAI.search(t)]
    return Tagger(*train_marks([t for t in texts if not _IS_THAI.search(t)]), *train_blanks(unmarked))


def fit(documents: DataFrame) -> Tagger:
    """A tagger trained on the texts with the smallest hashes, a bounded number of each kind."""
    n = documents.count()
    # about so many times the wanted number are looked at, in one pass; their hashes choose among them
    share = lambda times: int(min(1.0, times * TRAIN_DOCUMENTS / max(1, n)) * (1 << 40))
    unmarked = F.col("text").rlike(f"[{_THAI}]")
    near = documents.where(F.pmod(F.xxhash64("text"), F.lit(1 << 40)) < F.when(unmarked, share(20)).otherwise(share(2)))
    rows = sorted({(r.h, r.text, r.unmarked) for r in near.select(F.xxhash64("text").alias("h"), "text", unmarked.alias("unmarked")).limit(24 * TRAIN_DOCUMENTS).collect()})
    return train(sorted(r[1] for kind in (False, True) for r in [r for r in rows if r[2] == kind][:TRAIN_DOCUMENTS]))


def split_sentences(documents: DataFrame) -> DataFrame:
    """``doc_id``, ``sent_no``, ``start_pos``, ``end_pos`` of every sentence of the documents (doc_id, text)."""
    tagger = fit(documents)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [tagger.units(t) for t in b.column("text").to_pylist()]
            n = np.fromiter(map(len, found), np.int64, len(found))
            places = np.fromiter((x for us in found for u in us for x in u), np.int32, 2 * int(n.sum())).reshape(-1, 2)
            number = np.arange(1, len(places) + 1) - np.repeat(np.cumsum(n) - n, n)
            columns = [np.repeat(b.column("doc_id").to_numpy(zero_copy_only=False), n), number.astype(np.int32), places[:, 0], places[:, 1]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["doc_id", "sent_no", "start_pos", "end_pos"])

    return once(documents.where("doc_id is not null and text is not null").select("doc_id", "text")).mapInArrow(run, "doc_id long, sent_no int, start_pos int, end_pos int")


def once(documents: DataFrame) -> DataFrame:
    """The documents (doc_id, text) with one row per identifier: of several texts the first by code point.

    Identifiers are counted; only the texts of repeated ones meet, the others stay where they are.
    """
    again = cut(documents.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id"))
    if again.limit(1).count() == 0:
        return documents
    repeated = documents.join(again, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("text").alias("text"))
    return documents.join(again, "doc_id", "left_anti").unionByName(repeated)
