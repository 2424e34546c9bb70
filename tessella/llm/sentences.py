"""Problem 9: sentences of documents in many languages and scripts.

A document is read as blocks: the head (court, case, parties), then sections, each a heading and its
paragraphs. Page headers and ruled lines are taken out, so that a paragraph broken by one is whole
again. In a paragraph every mark that could end a sentence is a candidate; a semi-Markov dynamic
program chooses the sequence of whole spans between candidates with the highest total score. A
span's score adds up how well its first words open a sentence, how well its last words close one,
whether quotations and brackets are balanced within it, and its length.

Thai goes through the same program: blanks between two Thai characters are its candidates.

Documents are independent: one pass over Arrow batches, no exchange. The lists of abbreviations below are of legal and general
writing; ``learn_abbreviations`` finds those of other texts by a likelihood ratio over all documents, and ``sentences`` takes them.

Defined results: a null or empty text has no sentences; the end of a paragraph always ends a
sentence; a text without blank lines is one section without heading; nothing is cut off however long
a text or a paragraph is.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Abbreviations that never end a sentence, as they stand before the full stop.
NEVER = frozenset(
    """Gen Sgt Lt Col Capt Maj Cpl Adm Rev Hon Sen Gov Pres Mt Ft Ave Blvd Rd Dept Univ approx
    R.S Mr Mrs Ms Dr Prof St No Nos no nos p pp para paras Art Arts art arts sec secs cf Cf resp op vol vols Rep v vs esq ca i.e e.g viz ed eds al
    Jan Feb Mar Apr Jun Jul Aug Sep Sept Oct Nov Dec jan janv févr avr juill sept oct nov déc ene feb abr ago
    Okt Dez Mär Nr Rn Rz Abs Bd Hr Hrn Fr Fa Gem gem Rechtsanw vgl Vgl bzw z Z B d h u s i Az geb
    M Mme Me MM c.-à-d chap n av boul Sr Sra Dra Dr D Da avda Avda núm pág págs EE UU ss Exp
    т е ул д стр п пп ст ч руб гр Гр см янв февр мар апр авг сент окт нояб дек тыс им
    د ص ب""".split()
)
# Abbreviations that may end a sentence or stand within one.
MAYBE = frozenset("Ltd Co Cie Inc Corp Jr S.A S.L U.K.S K.S U.S a.m p.m etc usw V N a M д г UU infra o".split())
# German words between an ordinal and what it orders, and what follows ordinals.
ORDINAL_BEFORE = frozenset("Der Die Das der die das Am am vom Vom zum Zum des dem den zu Zu Im im".split())
ORDINAL_AFTER = re.compile(r"\s+(?:Jan|Feb|März|Mär|April|Apr|Mai|Juni|Jun|Juli|Jul|Aug|Sept|Sep|Okt|Nov|Dez|Januar|Februar|August|September|Oktober|November|Dezember|Senat|Kammer|d\. M)\b")
# Words that go on with a sentence after a name, in scripts without case.
GO_ON_ARABIC = ("صارخا", "وفق", "باع", "لم", "الذي", "التي", "تجاوز", "أنكر", "فسخ", "استند", "رفض", "طالب", "إلخ", "دون", "ضد")
GO_ON_CHINESE = ("未", "解除", "援引", "主张", "应", "出售", "承担", "驳回", "逾期", "否认", "亦", "高喊", "曾", "问", "提出")
SAID_HINDI = ("कहा", "पूछा", "लिखा", "बोला")
# Words that connect a new sentence to the one before.
CONNECTIVES = ("However,", "Moreover,", "In any event,", "At about ", "Cf. infra;", "Allerdings ", "Im Übrigen ", "Z. B. ", "Gem. §", "Toutefois,", "En outre,", "Vu l'art", "Sin embargo,", "Además,", "Кроме того,", "Однако ", "ومع ذلك", "كما أن", "इसके अलावा", "परन्तु")
THAI_OPENERS = ("นอกจากนี้", "เมื่อวันที่", "อย่างไรก็ดี", "ผู้เช่า", "ผู้ปกครอง", "ศาลชั้นต้น", "พยาน", "ผู้รับประกัน", "ทนายความ", "ฝ่าย", "โจทก์", "จำเลย")
THAI_CLOSERS = ("ที่สอง", "กำหนด", "คู่ความ", "เหตุผล", "วันทำการ", "วันนัด", "ทั้งหมด", "จนสิ้น", "แล้ว")

DOCKET = r"[A-Z]{2}-\d{4}-\d+"
PAGE_HEADER = re.compile(rf"— \d+ —|\[{DOCKET}, \d+\]|.* · {DOCKET} · \d+/\d+|{DOCKET}(?: -)? \D{{0,8}}\d+\D{{1,9}}\d+\D{{0,2}}")
HEADER_END = re.compile(r"(?:[—\]]|\d\D{0,2})\s*\Z")
RULE = " \t_-=—–*·~"
NUMBER = re.compile(r"(?:\(\d+\)|\[\d+\]|\d+[.)])\s+")
OPEN, CLOSE = "([“„«‘「（『【", ")]”»’」）』】"
SPACED = re.compile(r"[(\[“„«‘）)\]”»’\"]|\.{1,4}(?=[\s)\]”“»’\"!?]|$)|[!?؟…]+")
HINDI = re.compile(r"[(\[“„«‘）)\]”»’\"]|[।॥!?…]+")
CJK = re.compile(r"[(\[“「（『【)\]”」）』】]|(?:…+)?[。！？!?]+|…+")
MIXED = re.compile(r"[a-z]{1,2}[A-Z]|[a-z]-[a-z]{3}")
LATIN_NAME = re.compile(r"[A-ZÀ-ÖØ-ÞА-ЯЁ]")
UNCASED_NAME = re.compile(r"[ऀ-ॿ؀-ۿ]")
THAI_BLANK = re.compile(r"(?<=[฀-๿])[  ]+(?=[฀-๿])")
NO = -40.0


def script_of(part: str) -> str:
    """``thai``, ``hindi``, ``cjk``, ``arabic`` or ``spaced``, by the most frequent script of a paragraph; empty without letters."""
    counts = {
        "thai": len(re.findall("[฀-๿]", part)),
        "hindi": len(re.findall("[ऀ-ॿ]", part)),
        "cjk": 2 * len(re.findall("[぀-ヿ一-鿿]", part)),
        "arabic": len(re.findall("[؀-ۿ]", part)),
        "spaced": len(re.findall("[A-Za-zÀ-ÿА-яЁё]", part)),
    }
    return max(counts, key=counts.get) if any(counts.values()) else ""


def paragraphs(text: str) -> Iterator[list[tuple[int, str]]]:
    """The paragraphs of running text, each as its pieces ``(offset, text)`` between page headers."""
    blocks: list[list[tuple[int, str, bool]]] = [[]]
    at, after_header = 0, False
    for line in text.split("\n"):
        if not line.strip():
            if blocks[-1]:
                blocks.append([])
                after_header = False
        elif not line.strip(RULE) or HEADER_END.search(line) and PAGE_HEADER.fullmatch(line.strip()):
            after_header = bool(blocks[-1])
        else:
            blocks[-1].append((at, line, after_header))
            after_header = False
        at += len(line) + 1
    blocks = [b for b in blocks if b]
    first = 1 if len(blocks) > 1 else 0
    for block in blocks[first:]:
        lines = block
        if first and len(lines[0][1]) < 60 and lines[0][1].rstrip()[-1] not in ".!?…؟।॥。！？":
            lines = lines[1:]
        whole: list[tuple[int, str]] = []
        for offset, line, joined in lines:
            numbered = NUMBER.match(line)
            if whole and not (joined and not numbered):
                yield whole
                whole = []
            if numbered:
                offset, line = offset + numbered.end(), line[numbered.end() :]
            whole.append((offset, line))
        if whole:
            yield whole


def opening(s: str, at: int) -> float:
    """How well the words at ``at`` open a sentence, in scripts with case."""
    c = s[at]
    if c == "(":
        n = s[at + 1 : at + 2]
        if s.startswith(("(No!", "(«", "(“", "(„")):
            return NO
        return opening(s, at + 1) if n and n not in "(“„«" and not s.startswith("No!", at + 1) else NO
    if c == "[":
        return 2.0 if s.startswith(("[redacted", "[…]"), at) else NO
    if c == "█" or c == "_":
        return 2.0
    if c.isupper():
        return 3.0
    if c.isdigit():
        return 1.5
    if c in "“„«‘\"¿¡—":
        return 0.5
    if c.islower():  # a blacked-out word, or a name with a lower-case particle
        if s.startswith("von ", at) and s[at + 4 : at + 5].isupper():
            return 2.0
        if s.startswith("xxx ", at):
            return 1.0
        return 1.0 if MIXED.match(s, at) else NO  # iPhone, e-mail
    return NO if c in ",;:)]»”" else 1.0


def last_words(s: str, start: int) -> list[str]:
    """At least the last three words before ``start``, whole, or all there are."""
    size = 40
    while True:
        left = max(0, start - size)
        words = s[left:start].split()
        if left == 0 or len(words) > 3:
            return words
        size *= 4


def closing(s: str, start: int, end: int, nxt: int, script: str, more: frozenset[str] = frozenset()) -> float:
    """How well the words before the mark ``s[start:end]`` close a sentence in a spaced script; ``more`` are learned abbreviations."""
    mark = s[start:end]
    if mark[0] != "." or len(mark) > 1:
        return 3.0
    words = last_words(s, start)
    word = words[-1].lstrip("(“„«‘[\"'") if words else ""
    if not word:
        return 0.0
    before = words[-2] if len(words) > 1 else ""
    last = re.split("[-'’]", word)[-1]
    if word.isdigit():
        if ORDINAL_AFTER.match(s, end) or (len(word) <= 3 and before.lstrip("(") in ORDINAL_BEFORE):
            return NO
        return 3.0
    if word == "г":
        month = words[-3] if len(words) > 2 else ""
        return NO if month.rstrip(".") in NEVER else 1.0
    if word in ("p.m", "a.m") and len(words) > 2 and words[-3] == "about":
        return NO
    if word == "д":
        return 1.0 if before.endswith("т.") else NO
    if word == "V":
        return 1.0 if before.endswith("e.") else NO
    if word == "M":
        return 1.0 if before == "d." else NO
    if word == "N":
        return 1.0 if before.endswith("N.") and (not s.startswith("N.", nxt) or s.startswith("N. N.", nxt)) else NO
    if word == "a":
        return 1.0 if before.endswith("u.") else 3.0
    if word == "e" and s.startswith("V.", nxt):
        return NO
    if word in MAYBE:
        return 1.0
    if word.lower() in more:
        return NO
    if word in NEVER or last in NEVER or (len(word) == 1 and word.isupper()):
        return NO
    if "." in word and len(word) <= 4 and word.lower() not in ("..", "..."):
        return 1.0
    return 3.0


def candidates(s: str, script: str, more: frozenset[str] = frozenset()) -> list[tuple[int, float, int, int, int, float]]:
    """``(end, close score, depth, bracket start, next start, next open score)`` of every possible end."""
    out = []
    stack: list[tuple[str, int]] = []
    n = len(s)
    cjk, hindi, arabic = script == "cjk", script == "hindi", script == "arabic"
    events = (CJK if cjk else HINDI if hindi else SPACED).finditer(s)
    skip = 0
    for m in events:
        at = m.start()
        if at < skip:
            continue
        c = s[at]
        if c == '"':
            if stack and stack[-1][0] == '"':
                stack.pop()
            else:
                stack.append((c, at))
            continue
        if c in OPEN and not (c == "“" and stack and stack[-1][0] == "„"):
            stack.append((c, at))
            continue
        if c in CLOSE or c == "“":
            if stack:
                stack.pop()
            continue
        end = m.end()
        closed = None
        e = end
        while e < n:
            d = s[e]
            if d in CLOSE or (d == "“" and stack and stack[-1][0] == "„") or (d == '"' and stack and stack[-1][0] == '"'):
                if stack:
                    closed = stack.pop()
                e += 1
            elif d in "   " and s[e + 1 : e + 2] == "»":
                e += 1
            else:
                break
        skip = e
        nxt = e
        while nxt < n and s[nxt].isspace():
            nxt += 1
        if nxt >= n:
            out.append((e, 5.0, len(stack), -1, n, 0.0))
            continue
        if stack:
            continue
        if closed and closed[0] == "[":
            continue
        bracket = closed[1] if closed and closed[0] in "(（" else -1
        quoted = closed[1] if closed and bracket < 0 else -1
        if cjk:
            if quoted >= 0 and s[quoted - 1 : quoted] not in ("：", ":"):
                continue
            if s[at] == "…" and end - at <= 2 and m.group()[-1] == "…" and s.startswith(GO_ON_CHINESE, nxt):
                continue
            if s[nxt] in "，、；：,;と":
                continue
            out.append((e, 3.0, 0, bracket, nxt, 2.0))
            continue
        if nxt == e and script != "spaced" and not hindi:
            continue
        if hindi or arabic:
            if quoted >= 0:
                intro = s[max(0, quoted - 12) : quoted].split()
                said = bool(intro) and (intro[-1].endswith(":") or intro[-1] in SAID_HINDI)
                if not said:
                    continue
            if s[nxt] in "،,;؛:)":
                continue
            if s[nxt] == "(" and s.startswith(("(देखें", "(मकान", "(انظر", "(ص."), nxt):
                continue
            if s[nxt] == "[" and not s.startswith(("[redacted", "[…]"), nxt):
                continue
            close = 3.0
            if arabic and s[at] == ".":
                close = closing(s, at, end, nxt, script, more)
                if close <= 1.0 and s.startswith(GO_ON_ARABIC, nxt):
                    continue
            if close > NO:
                out.append((e, close, 0, bracket, nxt, 2.0))
            continue
        if nxt == e:
            continue
        if quoted >= 0 and s[nxt] in "█[" and not s[:quoted].rstrip().endswith((":", ",", " that")):
            continue  # a blacked-out word after a quotation within the sentence
        op = opening(s, nxt)
        if op <= NO:
            continue
        close = closing(s, at, end, nxt, script, more)
        if close <= NO:
            continue
        if op == 1.0 and close < 3.0 and s[nxt].islower():
            op = 0.5
        out.append((e, close, 0, bracket, nxt, op))
    return out


def choose(s: str, begin: int, cands: list[tuple[int, float, int, int, int, float]], short: int = 3) -> list[int]:
    """Ends of the best segmentation: a semi-Markov dynamic program over whole spans.

    The score of the span from one candidate's next word to another candidate's end is the sum of
    the opening score of its first words, the closing score of its last, the balance of brackets and
    quotations (a bracket closed by the last words has to be the one that opens the span, or a reference
    like "(see ...)" that ends it), and its length, which is too short below ``short``.
    """
    k = len(cands)
    best = [0.0] * (k + 1)
    back = [0] * (k + 1)
    starts = [begin, *(c[4] for c in cands)]
    opens = [2.0, *(c[5] for c in cands)]
    most = [opens[0]]  # the most that any start up to here brings along
    for j in range(1, k + 1):
        end, close, depth, bracket, _, _ = cands[j - 1]
        top, arg = -1e18, j - 1
        for i in range(j - 1, -1, -1):
            start = starts[i]
            length = end - start
            if most[i] + close - 2.0 - max(0.0, (length - 400) * 0.002) < top - 1e-9:
                break  # no earlier start scores more: the rest of the terms only take away
            score = best[i] + opens[i] + close - 2.0
            if length < short:
                score -= 8.0
            elif length > 400:
                score -= (length - 400) * 0.002
            if bracket >= 0 and bracket != start and not s.startswith(("(see ", "(vgl. ", "(cf. "), bracket):
                score += NO
            if s[start : start + 1] in "(（" and bracket != start:
                score -= 6.0 if s.find(")" if s[start] == "(" else "）", start, end) < 0 else 0.0
            if depth:
                score -= 1.0
            if score >= top:
                top, arg = score, i
        best[j], back[j] = top, arg
        most.append(max(most[-1], top + opens[j]))
    ends, j = [], k
    while j:
        ends.append(cands[j - 1][0])
        j = back[j]
    return ends[::-1]


def thai_ends(pieces: list[tuple[int, str]]) -> list[int]:
    """Ends in a Thai paragraph: blanks between Thai characters are the candidates; between the pieces that a page header left, words
    that open after words that close."""
    text = "\n".join(line for _, line in pieces)
    cands, cuts, at = [], [], 0
    for p, (offset, line) in enumerate(pieces):
        cuts.append((at, offset))
        cands += [(at + m.start(), 3.0, 0, -1, at + m.end(), 2.0) for m in THAI_BLANK.finditer(line)]
        bare = len(line.rstrip())
        if p + 1 == len(pieces):
            cands.append((at + bare, 5.0, 0, -1, len(text), 0.0))
        elif pieces[p + 1][1].startswith(THAI_OPENERS) and line[:bare].endswith(THAI_CLOSERS):
            cands.append((at + bare, 3.0, 0, -1, at + len(line) + 1, 2.0))
        at += len(line) + 1
    return _placed(choose(text, len(text) - len(text.lstrip()), cands, short=0), cuts)


def _placed(found: list[int], cuts: list[tuple[int, int]]) -> list[int]:
    """Ends within the joined pieces as ends within the text; ``cuts`` are ``(where a piece begins, its offset)``."""
    if len(cuts) == 1:
        return [cuts[0][1] + f for f in found]
    out = []
    for f in found:
        start, offset = max(c for c in cuts if c[0] < f or c[0] == 0)
        out.append(offset + f - start)
    return out


def sentence_ends(text: str | None, more: frozenset[str] = frozenset()) -> list[int]:
    """Code points up to and including the last character of each sentence of running text."""
    if not text:
        return []
    ends: list[int] = []
    for pieces in paragraphs(text):
        script = script_of("\n".join(line for _, line in pieces)) or script_of(text) or "thai"
        if script == "thai":
            ends += thai_ends(pieces)
            continue
        s = pieces[0][1]
        cuts = [(0, pieces[0][0])]
        soft = []
        for offset, line in pieces[1:]:
            bare = s.rstrip()
            if line.startswith(CONNECTIVES) and bare and bare[-1] not in ".!?…؟।॥。！？,;:" and bare[-1] not in CLOSE:
                soft.append((len(bare), 3.0, 0, -1, len(s) + 1, 3.0))
            cuts.append((len(s) + 1, offset))
            s += "\n" + line
        tail = len(s.rstrip())
        begin = len(s) - len(s.lstrip())
        cands = candidates(s, script, more)
        if soft:
            cands = sorted({c[0]: c for c in [*cands, *soft]}.values())
        if not cands or cands[-1][0] < tail:
            cands.append((tail, 3.0, 0, -1, len(s), 0.0))
        found = choose(s, begin, cands)
        ends += _placed(found, cuts)
    return ends


MOST_LEARNED = 5000


def learn_abbreviations(docs: DataFrame, least_score: float = 10.0, least_count: int = 3) -> list[str]:
    """Words, in small letters, that stand before a full stop far more often than chance: abbreviations of the documents' own.

    For every word of a spaced script the log-likelihood ratio compares how often a full stop follows it with how often one follows
    any word (counts over all documents, combined on the map side). It is weighed down by the word's length and by its occurrences without a
    full stop, and only words that go on with a small letter, a digit or another word's capital within the line count. At most the
    MOST_LEARNED highest scores come to the driver.
    """
    word = r"(?<![\p{L}.])(\p{L}{1,12}(?:\.\p{L}{1,3})*)(\.?)(?=\s+[\p{L}\d(])"
    pairs = docs.select(F.explode(F.regexp_extract_all("text", F.lit(word), F.lit(0))).alias("t")).select(F.lower(F.regexp_replace("t", r"\.$", "")).alias("word"), F.endswith("t", F.lit(".")).alias("dot"))
    counts = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.count_if("dot").alias("dots"))
    total, dotted = counts.agg(F.sum("n"), F.sum("dots")).first()
    if not total or not dotted:
        return []
    p, q = dotted / total, 0.99
    yes, no = F.col("dots"), F.col("n") - F.col("dots")
    ratio = 2 * (yes * F.log(F.lit(q / p)) + no * F.log(F.lit((1 - q) / max(1e-12, 1 - p))))
    score = ratio * F.exp(-F.length("word").cast("double")) * 10 * F.pow(F.length("word").cast("double"), -no)
    top = counts.where(yes >= least_count).withColumn("score", score).where(F.col("score") >= least_score).orderBy(F.desc("score"), "word").limit(MOST_LEARNED)
    return [r.word for r in top.select("word").collect()]


def _split(batches: Iterator[pa.RecordBatch], more: frozenset[str] = frozenset()) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids, out_id, out_end = b.column(0).to_pylist(), [], []
        for doc, text in zip(ids, b.column(1).to_pylist()):
            ends = sentence_ends(text, more)
            out_id += [doc] * len(ends)
            out_end += ends
        yield pa.record_batch([pa.array(out_id, pa.int64()), pa.array(out_end, pa.int64())], names=["doc_id", "sent_end"])


def sentences(docs: DataFrame, abbreviations: list[str] | None = None) -> DataFrame:
    """``(doc_id, sent_end)``: one row for each sentence of running text; ``abbreviations`` as ``learn_abbreviations`` gives them."""
    more = frozenset(a.lower() for a in abbreviations or ())
    return docs.select("doc_id", "text").mapInArrow(lambda it: _split(it, more), "doc_id long, sent_end long")
