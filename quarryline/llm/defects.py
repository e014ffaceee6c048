"""Problem 5: broken prompt and response pairs.

A multi-label linear classifier on hashed n-grams of the answer and features of the pair. It is trained on all rows and on
responses made from them: emptied, cut inside a sentence, refused, copied from the question, swapped for an answer in another
language. The rows are fitted in blocks by the executors, and the weights of all blocks are averaged. Thresholds come from the
scores of all rows, each by the weights of blocks that do not hold it. All rows are scored with the fitted weights.
"""

from __future__ import annotations

import functools
import itertools
import math
import random
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import Cuts
from .codepoints import Words, alnum_table, byte_sizes, codepoints, mix, row_slices, span_hashes

LABELS = ("empty_answer", "truncated_answer", "refusal", "copied_question", "wrong_language")
BLOCK_ROWS, BLOCK_CHARS = 6_000, 2_000_000  # about as many pairs and characters are fitted at once; every pair is in a block
TASK_BLOCKS = 32  # a task fits so many blocks at most and sends one sum of them
DIMENSIONS = 1 << 18
PAIR_DIMENSIONS = 1 << 12  # the first ones, of features of the pair; copies and languages are judged by these alone
PAIR_LABELS = (3, 4)
LANGUAGE_DIMENSIONS = 1 << 16
TRAIN_SHARE = 0.2  # weight of a label's pairs against all others in the last fit
WORDED_LABELS = (2,)  # told by their wording, of which no list is complete
SET_ASIDE = 0.04  # share of a block's pairs, those most like such a defect, that does not stand for pairs without it
LEAST_SHARE = 1e-4  # a defect is expected in no smaller share of the rows, whatever the estimate
KNOWN_SHARE = 1e-4  # a word is known in a language if it is in more than such a share of all texts (and in three)
PRESENT_SHARE = 1e-3  # a language with less than such a share of all words (and 500) is none of the table
GRID = 1 << 20  # weights are summed as whole multiples of 1 / GRID, so that no order of the blocks changes a sum
STEADY, LEAST_FALL, CLEANING_FALL = 3, 0.005, 0.05  # a fit ends when so many steps together lower its loss by less than such a share; one that only cleans
BINS, BIN = 1 << 13, 1 / 64  # scores are counted by bins of this width, those beyond in the outer ones
BATCH_BYTES = 1 << 19

# Common words of languages, by which texts are told apart; what is like none of them is judged by strange words and scripts.
COMMON = {
    "en": "the of and to that for must what which how is in by on a an does did when who has from under be its was it with only no yes after day because so at",
    "de": "der die das und wird nicht wann welche welcher zum für tage lang wurde weil den dem hat ein eine im nach muss bei auf von mit ist zu am sieht weshalb",
    "fr": "le la les de du et est à pour dans quelle quel une un été pourquoi au des elle que par sur en pas sans doit après",
    "es": "el la los las de y en por para qué cuándo se que según una un al del si con no fue cuándo plazo debe",
    "ru": "в на и по не что за из к от когда какой почему был была для при через после срока согласно компания должна",
    "it": "il lo la gli le di e è che per un una non del della dei con da nel sono come più quando alla entro deve stato",
    "pt": "o a os as de e é que para um uma não do da dos das com em por se no na como quando foi deve mais ao",
    "nl": "de het een en van is dat voor niet met op te in aan die wordt er bij ook na door wanneer welke moet heeft",
    "pl": "i w na z do nie się że to jest o po dla od przez oraz jak który która kiedy dni musi czy został",
}
# Words that stand for no answer, and what they may stand in.
PLACEHOLDERS = "n/a|na|n.a.|none|null|nil|nan|tbd|tba|todo|to do|blank|empty|unknown|undefined|missing|pending|unavailable|not available|not applicable|not provided|not specified|not given|no answer|no response|no data|no text|to be determined|to be added|to be confirmed|placeholder|leer|keine Angabe|sin respuesta|sin datos|sans réponse|néant|vide|нет ответа|нет данных|пусто".split("|")
WRAPPERS = ("{}", "{}", "{}", "({})", "[{}]", "<{}>", '"{}"', "-{}-", "{}.", "*{}*")
BLANKS = ["", " ", "\n", "\t \n", "\u00a0", "\u200b", "-", "--", "—", "...", "…", "?", ".", "*", "/", "_", "()", '""', "!?", "- -", "[ ]"]
# What a question given back may begin with.
ECHOES = ("Q: ", "Question: ", "Frage: ", "Pregunta: ", "Вопрос: ", "You asked: ", "The question is: ")
# Families of ways to decline, in general words. (a|b) stands for one of its parts, {} for what was asked about.
REFUSALS = {
    "apology": (
        "(Sorry|I'm sorry|I am sorry|My apologies|Apologies|I apologise), (but |)(I|we) (can't|cannot|can not|am not able to|are unable to|could not) (answer|help with|assist with|do|provide|say|respond to) (this|that|it|your question|such requests|what you ask)(.|, I'm afraid.|, unfortunately.)",
        "(Unfortunately|Regrettably|Sadly|I'm afraid|I regret that) I (can't|cannot|am unable to|am not able to) (give|offer|provide|share|supply) (an answer|a reply|that information|details on {}|any help here)(.| at this time.)",
        "(Es tut mir leid|Tut mir leid|Entschuldigung|Leider), (aber |)(das|diese Frage|das hier) kann ich (leider |)nicht (beantworten|sagen|klären).|(Lo siento|Lo lamento|Disculpe|Perdón), (pero |)no puedo (responder|contestar|ayudar con) (a esto|a eso|esa pregunta).",
        "(Désolé|Je suis désolée|Je regrette|Pardon|Navré), (mais |)je ne peux pas (répondre|vous aider|donner de réponse)( à cela| à cette demande|).|(Извините|Простите|Прошу прощения|К сожалению), (но |)я не (могу|смогу|в состоянии) (ответить|помочь|сказать)( на это| с этим|).",
    ),
    "inability": (
        "I (can't|cannot|am unable to|am not able to|have no way to|lack the means to) (answer|determine|work out|tell you|establish|confirm|verify|judge) (this|that|it|what {} says|the answer|whether this is so)(.| here.| with certainty.)",
        "It is (not possible|impossible) (for me |)to (answer|say|tell|reply|give an answer)( to this| on {}| about that|).|(I'm|I am) not (in a position|equipped|qualified) to (answer|reply|comment|advise)( on {}| on this|).",
        "Ich (kann|bin außerstande,) (dazu|darauf|hierzu) (keine Antwort geben|nicht antworten|nichts sagen).|No (puedo|soy capaz de|me es posible) (responder|contestar|decirlo|opinar)( sobre {}| sobre esto|).|Je (ne peux pas|suis incapable de|ne suis pas en mesure de) (répondre|dire cela|me prononcer)( sur {}| à ce sujet|).|Я не (могу|способен|в силах) (ответить|сказать|судить)( о {}| об этом|).",
    ),
    "unwilling": (
        "I (won't|will not|would rather not|prefer not to|refuse to|decline to|must decline to|have to decline to|choose not to) (answer|comment|discuss|speak about|go into|engage with|speculate on) (this|that|{}|the matter|such questions)(.| any further.)",
        "(I'll|I will|Let me|I'd rather|I would) (pass on|skip|stay out of|leave) (this one|that question|this topic|{}).|No comment( on {}| on that|).",
        "(Darüber|Dazu|Über {}) möchte ich (nicht sprechen|keine Auskunft geben|mich nicht äußern).|Prefiero no (responder|hablar de {}|opinar)( sobre eso|).|Je (préfère|souhaite) ne pas (répondre|parler de {}|commenter).|Я (не буду|предпочитаю не|отказываюсь) (отвечать|обсуждать {}|комментировать это).",
    ),
    "ignorance": (
        "I (don't|do not) (know|have the answer|have that information|have any information on {}|have enough information|recall)(.| about this.| for certain.)",
        "(I have|There is|We have) (no|not any) (idea|information|data|knowledge|record)( about {}| on this| of that|)(.| to go on.)|(I'm|I am) not (sure|certain|aware of the answer)(.| about {}.)",
        "(Das|Die Antwort) weiß ich (leider |)nicht.|(Ich habe|Mir liegen) (keine|nicht genug) (Informationen|Angaben|Kenntnis)( zu {}| darüber| vor|).|No (sé|lo sé|conozco la respuesta|tengo información|dispongo de datos)( sobre {}| sobre esto|).|Je (ne sais pas|ne connais pas la réponse|n'ai pas d'information|n'ai aucune idée)( sur {}| à ce sujet|).|Я не (знаю|знаю ответа|располагаю сведениями|имею данных)( о {}| об этом|).",
    ),
    "material": (
        "The (text|context|passage|material|document|evidence|source|excerpt)(s|) (provided |given |supplied |)(does not|do not|doesn't|don't) (say|mention|contain the answer|cover {}|include this|give enough detail|state it)(.|, so I (cannot|can't) (answer|tell|say).)",
        "(There is|There's) (not enough|too little|insufficient|no) (context|evidence|information|detail) (here |)(to answer|to say|to decide|for an answer|on {})(.| in what was provided.)|(Nothing|None of this) in the (text|material|sources) (answers|addresses|speaks of) (this|the question|{}).",
        "(Der Text|Die Unterlage|Der Kontext) (nennt|enthält|erwähnt) (das|dies|die Antwort|{}) nicht.|El (texto|contexto|documento) no (menciona|contiene|indica) (eso|la respuesta|{}).|Le (texte|contexte|document) ne (mentionne|contient|précise) pas (cela|la réponse|{}).|(Текст|Контекст|Документ) не (содержит|упоминает|указывает) (ответа|этого|{}).",
    ),
    "role": (
        "As (an AI|an AI model|a language model|an assistant|an AI assistant|a chatbot|a virtual assistant), I (cannot|can't|do not|am not able to|am not allowed to) (answer|have opinions on|have access to|give advice on|comment on|look up) (this|{}|such matters|that).",
        "(I'm|I am) (only |just |)(an AI|a language model|a program|an assistant) and (cannot|can't|do not) (know|answer|judge|access|see) (this|that|{}).|Als (KI|Sprachmodell|Assistent) (kann|darf) ich (dazu nichts sagen|das nicht beantworten).|Como (IA|modelo de lenguaje|asistente) no (puedo|debo) (responder|opinar)( sobre {}|).|En tant que (IA|modèle de langage|assistant), je ne (peux|dois) pas (répondre|commenter)( sur {}|).|Как (ИИ|языковая модель|помощник) я не (могу|вправе) (ответить|судить)( о {}|).",
    ),
    "policy": (
        "(My|Our|The) (rules|guidelines|policies|instructions|terms|settings) (do not|don't) (allow|permit|let) (me|us) to (answer|discuss {}|reply|help with this|share that).|(This|That|The request|Your question|{}) (is|falls|lies) (outside|beyond) (my|our|the) (scope|remit|guidelines|mandate|limits|competence).",
        "(I am|I'm|We are) not (allowed|permitted|authorised|supposed) to (answer|discuss|disclose|share|comment on) (this|that|{}|such things).|(This|That) (topic|request|content) is (restricted|not permitted|against policy).|(It would be|It is|It would not be right or|It seems) (inappropriate|improper|not appropriate|unsuitable|wrong|not right) (for me |)to (answer|comment|say more|respond)( on {}|).",
        "Das (darf|soll) ich nicht (beantworten|mitteilen|sagen).|(Meine|Die) (Regeln|Richtlinien) (erlauben|gestatten) (das|diese Antwort) nicht.|Mis (normas|reglas) no (permiten|autorizan) (responder|hablar de {}).|Mes (règles|consignes) ne (permettent|autorisent) pas (de répondre|d'aborder {}).|(Правила|Инструкции) не (позволяют|разрешают) мне (отвечать|обсуждать {}).",
    ),
    "referral": (
        "(Please|Kindly|You should|It is best to|I suggest you) (consult|ask|contact|speak to|turn to|check with) (a lawyer|an expert|a professional|the authority|the competent office|your adviser)( about {}| on this| instead|)(.|, as I (cannot|can't) (answer|advise).)",
        "(For|On) {}, (please |)(see|consult|refer to|ask) (someone else|other sources|a specialist|the original).|Bitte (wenden Sie sich an|fragen Sie) (einen Fachmann|die Behörde|einen Anwalt).|(Consulte|Pregunte) (a un abogado|a un experto|a la autoridad).|(Veuillez consulter|Adressez-vous à) (un avocat|un expert|l'autorité).|Обратитесь к (юристу|специалисту|ведомству).",
    ),
    "impersonal": (
        "(This|That|The|Such a) question (cannot|can't|can not|could not) be (answered|resolved|settled)( here| from this|).|No (answer|response|reply|information) (can|could) be (given|provided|offered|produced|found)( for this| here| on {}|).",
        "(The answer|A reply|This information) is (not available|not known|unknown|unavailable to me|withheld)(.| at present.)|(Unable|Not able) to (answer|respond|help|comply|say)( on {}| with this|).|(Cannot|Can't|Won't) (answer|say|tell|help)( that| this| on {}|).",
        "(Diese Frage|Das) (lässt sich nicht|kann nicht) (beantworten|beantwortet werden).|No (se puede|es posible) (responder|dar respuesta)( a esto|).|(Il n'est pas possible|Impossible) de (répondre|donner une réponse)( à cela|).|(Ответить|Дать ответ) (невозможно|нельзя|не получится).",
    ),
}
# First code points of blocks of one script each, with the script.
SCRIPTS = ((0x41, "latin"), (0x370, "greek"), (0x400, "cyrillic"), (0x530, "armenian"), (0x590, "hebrew"), (0x600, "arabic"), (0x900, "indic"), (0xE00, "thai"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x2C80, "other"), (0x3040, "kana"), (0x3100, "han"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"), (0xFB13, "other"), (0xFF21, "latin"), (0xFF66, "kana"), (0xFFA0, "hangul"), (0x10000, "other"), (0x20000, "han"))
_LANGUAGES = tuple(COMMON)
_COMMON_SETS = {k: frozenset(v.split()) for k, v in COMMON.items()}
_WORD = re.compile(r"[^\W_]+")
_TOPIC = re.compile(r"(?:[^\W\d_a-zа-я][^\W\d_]+ ){1,2}[^\W\d_a-zа-я][^\W\d_]+|\w+ ?[\w/]*\d[\w/()]*|\bthe (?:\w+ ){1,3}\w+")
_MARKS = np.zeros(0x110000, np.uint8)  # class of the last character that is no blank: 0 other
for _class, _chars in enumerate((".。", "!?！？…", ",;:，；：", ")]}\"'”’»*", "([{-–—"), 1):
    for _c in _chars:
        _MARKS[ord(_c)] = _class


_SCRIPT_STARTS = np.array([x[0] for x in SCRIPTS])
_SCRIPT_NAMES = sorted({x[1] for x in SCRIPTS})
_SCRIPT_AT = np.array([_SCRIPT_NAMES.index(x[1]) for x in SCRIPTS])
_JOINED = [_SCRIPT_NAMES.index(x) for x in ("han", "kana", "thai")]
@functools.cache
def _choices(template: str) -> list[list]:
    """The sentences of a template, each a list of texts and of choices of the same form."""
    top: list[list] = [[]]
    around = []
    for part in re.split(r"([()|])", template):
        if part == "(":
            around.append(top)
            top = [[]]
        elif part == ")":
            top, inner = around.pop(), top
            top[-1].append(inner)
        elif part == "|":
            top.append([])
        elif part:
            top[-1].append(part)
    return top


def _one_of(some: list, rng: random.Random):
    return some[int(rng.random() * len(some))]


def spun(template: str | list, rng: random.Random) -> str:
    """A template with one part of each choice; at the top, bars part whole sentences."""
    said = _one_of(_choices(template) if isinstance(template, str) else template, rng)
    return "".join([x if isinstance(x, str) else spun(x, rng) for x in said])


def refusal(topic: str, rng: random.Random, families: tuple[str, ...] = tuple(REFUSALS)) -> str:
    """A refusal of one of the families, sometimes with a second one behind it."""
    said = spun(_one_of(REFUSALS[_one_of(families, rng)], rng), rng)
    if rng.random() < 0.2:
        said += " " + spun(_one_of(REFUSALS[_one_of(families, rng)], rng), rng)
    return said.replace("{}", topic)


def language(text: str) -> str | None:
    """The language whose common words a text holds most of; None where it holds less than two or two languages tie."""
    tokens = _WORD.findall(text.casefold())
    found = sorted(((sum(t in s for t in tokens), k) for k, s in _COMMON_SETS.items()), reverse=True)
    return found[0][1] if found[0][0] > max(1, found[1][0]) else None


class _Side:
    """Words of one column with exact hashes and hashes of shapes (every digit alike)."""

    def __init__(self, column: pa.Array):
        w = Words(column)
        shaped = np.where((w.codes >= 48) & (w.codes <= 57), np.uint32(48), w.codes)
        self.n_rows, self.row = w.n_rows, w.row
        self.exact, self.shape = w.hashes, span_hashes(shaped, w.starts, w.ends)
        self.count = np.bincount(w.row, minlength=w.n_rows)
        self.stop = np.cumsum(self.count)
        # Words that may tell a language: two letters or more, no digit. The script of a word is that of its first letter.
        digit = np.zeros(len(w.codes) + 1, np.int64)
        np.cumsum((w.codes >= 48) & (w.codes <= 57), out=digit[1:])
        self.plain = np.flatnonzero((digit[w.ends] == digit[w.starts]) & (w.ends - w.starts > 1))
        self.script = _SCRIPT_AT[np.maximum(np.searchsorted(_SCRIPT_STARTS, w.codes[w.starts], side="right") - 1, 0)]
        self.letters = w.ends - w.starts
        # Scripts without blanks between words: two letters count as a word more.
        joined = np.flatnonzero(np.isin(self.script, _JOINED))
        self.hidden = np.bincount(w.row[joined], weights=self.letters[joined] // 2, minlength=w.n_rows).astype(np.int64)


    def part(self, rows: np.ndarray) -> "_Side":
        """The side of some of the texts."""
        out = object.__new__(_Side)
        out.n_rows, out.count, out.hidden = len(rows), self.count[rows], self.hidden[rows]
        out.row, out.stop = np.repeat(np.arange(len(rows)), out.count), np.cumsum(out.count)
        word = out.row.size and np.arange(out.row.size) + np.repeat(self.stop[rows] - out.stop, out.count)
        out.exact, out.shape, out.script, out.letters = ((x[word] if out.row.size else x[:0]) for x in (self.exact, self.shape, self.script, self.letters))
        plain = np.zeros(len(self.row), bool)
        plain[self.plain] = True
        out.plain = np.flatnonzero(plain[word]) if out.row.size else self.plain[:0]
        return out


def _last_marks(column: pa.Array) -> np.ndarray:
    """For each text 0 to 5 by its last character that is no blank, 6 for a letter or digit, 7 for none."""
    codes, offsets = codepoints(pa.compute.utf8_rtrim_whitespace(column))
    out = np.full(len(offsets) - 1, 7)
    full = np.diff(offsets) > 0
    last = codes[offsets[1:][full] - 1]
    out[full] = np.where(alnum_table()[last], 6, _MARKS[last])
    return out


def _held(some: np.ndarray, of: np.ndarray) -> np.ndarray:
    """np.isin for hashes: tables addressed by their first bits, and anew for those whose place another one took."""
    if not len(some) or not len(of):
        return np.zeros(len(some), bool)
    away = np.uint64(64 - (8 * len(of)).bit_length())
    place = (of >> away).astype(np.int64)
    table = np.full(1 << (8 * len(of)).bit_length(), of[0])
    table[place] = of
    asked = (some >> away).astype(np.int64)
    out = table[asked] == some
    lost = table[place] != of
    if lost.any():
        shared = np.zeros(len(table), bool)
        shared[place[lost]] = True
        again = np.flatnonzero(shared[asked] & ~out)
        out[again] = _held(mix(some[again]), mix(of[lost]))
    return out


def _buckets(values: np.ndarray, edges: list[float]) -> np.ndarray:
    return np.searchsorted(np.array(edges), values, side="right")


def language_scores(side: _Side, weights: np.ndarray) -> np.ndarray:
    """Log-odds of each language, a row for each text."""
    at = (side.shape % np.uint64(LANGUAGE_DIMENSIONS)).astype(np.int64)
    out = np.empty((side.n_rows, len(_LANGUAGES)))
    for k in range(len(_LANGUAGES)):
        out[:, k] = np.bincount(side.row, weights=weights[k][at], minlength=side.n_rows)
    return out


def script_shares(side: _Side) -> np.ndarray:
    """Share of the letters of each text's words in each script, a row for each text."""
    at = side.row[side.plain] * len(_SCRIPT_NAMES) + side.script[side.plain]
    held = np.bincount(at, weights=side.letters[side.plain], minlength=side.n_rows * len(_SCRIPT_NAMES)).reshape(side.n_rows, len(_SCRIPT_NAMES))
    return held / np.maximum(held.sum(1, keepdims=True), 1)


def strange_words(side: _Side, languages: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Share of each text's words that are not known in the language given for it; 0 without words."""
    at = (side.shape[side.plain] % np.uint64(LANGUAGE_DIMENSIONS)).astype(np.int64)
    row = side.row[side.plain]
    strange = np.bincount(row, weights=~known[languages[row], at], minlength=side.n_rows)
    return strange / np.maximum(np.bincount(row, minlength=side.n_rows), 1)


def features(question: pa.Array | _Side, answer: pa.Array, languages: "Languages", of: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of every feature that is on, rows in no order, each feature of a row once or more. of: the place of each answer's question, if not its own."""
    a, q = _Side(answer), question if isinstance(question, _Side) else _Side(question)
    n = a.n_rows
    of = np.arange(n) if of is None else of
    mark = _last_marks(answer)
    rows, marks = [], []

    def add(row: np.ndarray, h: np.ndarray, salt: int) -> None:
        rows.append(row)
        h = mix(h.astype(np.uint64) + np.uint64(salt * 0x9E3779B97F4A7C15 % (1 << 64)))
        wide = np.uint64(DIMENSIONS - PAIR_DIMENSIONS)
        marks.append(h % np.uint64(PAIR_DIMENSIONS) if salt >= 50 else np.uint64(PAIR_DIMENSIONS) + h % wide)

    # Words and pairs of words.
    add(a.row, a.shape, 1)
    two = np.flatnonzero(a.row[1:] == a.row[:-1])
    add(a.row[two], a.shape[two] * np.uint64(31) + a.shape[two + 1], 2)
    # The last one to five words, alone and with the final mark; the first three.
    for k in range(1, 6):
        has = np.flatnonzero(a.count >= k)
        chain = np.zeros(len(has), np.uint64)
        for j in range(k):
            chain = chain * np.uint64(1_000_003) + a.shape[a.stop[has] - k + j]
        add(has, chain, 10 + k)
        add(has, chain * np.uint64(8) + (mark[has] == 6).astype(np.uint64), 20 + k)
        if k <= 3:
            chain = np.zeros(len(has), np.uint64)
            for j in range(k):
                chain = chain * np.uint64(1_000_003) + a.shape[a.stop[has] - a.count[has] + j]
            add(has, chain, 30 + k)
    every = np.arange(n)
    size = _buckets(a.count + a.hidden, [1, 2, 3, 4, 6, 9, 14, 22, 40])
    # A whole short answer as one feature.
    short = np.flatnonzero((a.count > 0) & (a.count + a.hidden <= 3))
    chain = np.zeros(len(short), np.uint64)
    for j in range(3):
        more = a.count[short] > j
        chain[more] = chain[more] * np.uint64(1_000_003) + a.shape[(a.stop[short] - a.count[short] + j)[more]]
    add(short, chain, 40)
    add(every, size, 41)
    some = np.flatnonzero(a.count > 0)
    add(some, a.shape[a.stop[some] - 1] * np.uint64(16) + size[some].astype(np.uint64), 43)
    add(every, mark * 16 + size, 42)
    add(every, _buckets(np.bincount(a.row, weights=a.letters, minlength=n), [1, 3, 6, 10, 15, 20, 30]) * 16 + size, 44)
    # What answer and question share.
    tag = lambda hashes, row: mix(hashes ^ mix(row.astype(np.uint64)))
    in_q = np.bincount(a.row, weights=_held(tag(a.exact, of[a.row]), tag(q.exact, q.row)), minlength=n) / np.maximum(a.count, 1)
    asked = q.count[of]  # words of each answer's question, one after the other
    word = np.repeat((q.stop - q.count)[of] - (np.cumsum(asked) - asked), asked) + np.arange(asked.sum())
    row = np.repeat(every, asked)
    in_a = np.bincount(row, weights=_held(tag(q.exact[word], row), tag(a.exact, a.row)), minlength=n) / np.maximum(asked, 1)
    bins = [0.001, 0.2, 0.4, 0.6, 0.8, 0.9, 0.97, 0.9999]
    add(every, _buckets(in_q, bins) * 16 + _buckets(in_a, bins), 50)
    add(every, _buckets(in_q, bins) * 16 + size, 51)
    # Languages of both.
    la, lq = language_scores(a, languages.weights), language_scores(q, languages.weights)
    best_a, own = la.argmax(1), lq.argmax(1)
    best_q = own[of]
    lead = la[every, best_a] - la[every, best_q]
    sure = (lq[np.arange(q.n_rows), own] - np.partition(lq, -2, axis=1)[:, -2])[of]
    steps = [0.5, 1.5, 3, 6, 12, 24]
    # An answer whose words speak for no language here goes by its strange words alone.
    n_plain = np.bincount(a.row[a.plain], minlength=n) + a.hidden
    few = _buckets(n_plain, [1, 2, 3, 4, 6, 9])
    unknown = la[every, best_a] < 0.5 * n_plain
    add(every, np.where(unknown, 500, _buckets(lead, steps) * 16 + _buckets(sure, steps)), 60)
    apart = (best_a != best_q) * 1000 + size * 16 + _buckets(lead / np.maximum(a.count, 1), [0.1, 0.3, 0.6, 1, 2])
    add(every, np.where(unknown, 5000 + few, apart), 61)
    add(every, np.zeros(n, np.int64), 62)
    # Words strange to the language of the question and letters of other scripts, whatever language the answer is in.
    odd = strange_words(a, best_q, languages.known)
    add(every, _buckets(odd, [0.15, 0.3, 0.45, 0.6, 0.75]) * 16 + few, 63)
    more = odd - strange_words(q, own, languages.known)[of]
    for step, edge in enumerate((0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7)):  # each edge that is passed counts
        over = np.flatnonzero((odd > edge) & (few > 2))
        add(over, np.full(len(over), step), 64)
        over = np.flatnonzero((more > edge - 0.1) & (few > 2))
        add(over, np.full(len(over), step), 66)
    other = 1 - np.take_along_axis(script_shares(a), script_shares(q).argmax(1)[of][:, None], 1)[:, 0]
    letters = np.bincount(a.row[a.plain], weights=a.letters[a.plain], minlength=n)
    add(every, _buckets(np.where(n_plain > 0, other, 0), [0.05, 0.3, 0.5, 0.7, 0.9, 0.99]) * 16 + _buckets(letters, [4, 10, 20]), 65)
    return np.concatenate(rows), np.concatenate(marks).astype(np.int64)


_OPEN_WORDS = frozenset().union(*_COMMON_SETS.values()) - {"no", "yes", "so", "it", "not", "oui", "ja", "si", "da", "sì", "sim"}


_FULL_STOP = re.compile(r"\.$")
_BREAKS = ["", "", "", "", ",", " …", " (", " -", "..."]
_FOUR_WORDS, _FIVE_WORDS = (re.compile(rf"(?:[\W_]*[^\W_]++){{{k}}}") for k in (4, 5))
_SENTENCE_END, _SENTENCE_REST = re.compile(r"[.!?;|}:\n]\W*$"), re.compile(r"\W*[.!?;|}\n]|\W*$")


def _cut(answer: str, rng: random.Random) -> str | None:
    """The answer broken off inside a sentence, or None where it cannot be told from a whole one.

    One to three words show the break if the last one is a common word that needs another, or a part of a word.
    """
    if len(answer) < 4:
        return None
    least = int(len(answer) * 0.1)
    at = least + int(rng.random() * max(int(len(answer) * 0.97) - least, 1))
    kept = answer[:at].rstrip()
    if rng.random() < 0.5:
        kept = kept[: max(kept.rfind(" "), 0)].rstrip()
    rest = answer[len(kept) :]
    inside = kept[-1:].isalnum() and rest[:1].isalnum()
    if _SENTENCE_END.search(kept) or _SENTENCE_REST.match(rest) or not inside and answer.lstrip().startswith("{"):
        return None
    if not _FOUR_WORDS.match(kept):
        said = _WORD.findall(kept)
        if not (len(said) > 1 and inside and kept[-1:].isalpha() or said and said[-1].casefold() in _OPEN_WORDS and rest[:1] == " "):
            return None
    return kept + _one_of(_BREAKS, rng)


class _Tongue:
    """An invented language: letters of words change by a fixed rule, words stay apart. Stands for languages that no list names."""

    def __init__(self, rng: random.Random):
        vowels, consonants = list("aeiouyäöüáéíóúàèìòùêâôåø"), list("bcdfghjklmnpqrstvwxzçñłśšžß")
        shuffled = lambda x: sorted(x, key=lambda _: rng.random())
        self.letters = str.maketrans(dict(zip(vowels + consonants, shuffled(vowels) + shuffled(consonants), strict=True)))
        self.endings = ["".join([_one_of("aeiou" if k % 2 else "lnrstmd", rng) for k in range(int(rng.random() * 4))]) for _ in range(6)]
        self.script = _one_of([0] * 12 + [0x3B1, 0x430, 0x5D0, 0x627, 0x905, 0x3042, 0x4E00, 0xAC00], rng)

    def put(self, text: str, names: set[str]) -> str:
        """The text in the language; names and numbers stay."""

        def one(m: re.Match) -> str:
            w = m[0]
            if w in names:
                return w
            made = w.casefold().translate(self.letters) + self.endings[zlib.crc32(w.encode()) % len(self.endings)]
            return "".join(chr(self.script + (ord(c) * 7 + k) % 24) for k, c in enumerate(made)) if self.script else made

        made = re.sub(r"[^\W\d_]+", one, text)
        return made.replace(" ", "") if self.script in (0x3042, 0x4E00) else made


def _noisy(text: str, rng: random.Random) -> str:
    """Another final mark at times. No feature sees letter case and kinds of blanks, so these stay."""
    return _FULL_STOP.sub(_one_of(("", "", "!", "...", " "), rng), text) if rng.random() < 0.15 else text


def synthetic(pairs: list[tuple[str, str]], seed: int, families: tuple[str, ...] = tuple(REFUSALS)) -> tuple[list[str], list[str], np.ndarray]:
    """(questions, answers, labels as index into LABELS, -1 for none) made from pairs."""
    questions, answers, labels, *_ = made_of(pairs, seed, families)
    return questions, answers, labels


def made_of(pairs: list[tuple[str, str]], seed: int, families: tuple[str, ...], side: _Side | None = None) -> tuple[list[str], list[str], np.ndarray, np.ndarray, np.ndarray]:
    """The same, with the places in pairs that each is made of (of its question, of its answer) and how often it counts.

    The first one of each pair is the pair; a noisy one of it that is the same to all features counts with it. side: the questions.
    """
    rng = random.Random(seed)
    by_language: dict[str, list[int]] = {}
    asked, answer = _columns(pairs)
    tongues, answer_tongues = ([_LANGUAGES[k] if k >= 0 else None for k in tongues_of(x)] for x in (side or _Side(asked), _Side(answer)))
    for j, (k, (_, a)) in enumerate(zip(answer_tongues, pairs, strict=True)):
        if k and _FIVE_WORDS.match(a):
            by_language.setdefault(k, []).append(j)
    questions, answers, labels, sources, times = [], [], [], [], []

    def put(q: str, a: str, label: int, giver: int | None = None, n: int = 1) -> None:
        questions.append(q)
        answers.append(a)
        labels.append(label)
        sources.append((i, i if giver is None else giver))
        times.append(n)

    for i, (q, a) in enumerate(pairs):
        noisy = _noisy(a, rng)
        put(q, a, -1, n=1 + (noisy == a))
        if noisy != a:
            put(q, noisy, -1)
        for _ in range(2):
            if (cut := _cut(a, rng)) is not None:
                put(q, _noisy(cut, rng), 1)
        k = i % 4
        topics = (_TOPIC.findall(q) or q.split(" ")[-3:]) if k < 2 else []
        if k == 0:
            put(q, _noisy(_one_of(topics, rng), rng), -1)  # short and complete
            put(q, _one_of(BLANKS, rng) if rng.random() < 0.5 else _noisy(_one_of(WRAPPERS, rng).format(_one_of(PLACEHOLDERS, rng)), rng), 0)
        elif k == 1:
            for _ in range(2):
                put(q, _noisy(refusal(_one_of(("", "", "the filings of ", "cases such as "), rng) + _one_of(topics, rng), rng, families), rng), 2)
        elif k == 2 and q.strip():
            form = rng.random()
            copy = f'"{q}"' if form < 0.15 else f"{q} {q}" if form < 0.3 else _one_of(ECHOES, rng) + q if form < 0.5 else q.rstrip("?").rstrip() if form < 0.65 else q
            put(q, _noisy(copy, rng), 3)
        elif tongues[i]:
            others = [x for x in by_language if x != tongues[i]]
            if others:
                giver = _one_of(by_language[_one_of(others, rng)], rng)
                put(q, _noisy(pairs[giver][1], rng), 4, giver)
            words = _WORD.findall(a)
            if sum([w[0].islower() for w in words]) > 3:
                put(q, _noisy(_Tongue(rng).put(a, {w for w in words if w[0].isupper()} - set(words[:1])), rng), 4)
    return questions, answers, np.array(labels), np.array(sources, np.int64).reshape(-1, 2), np.array(times, np.int64)


def _dot(a: np.ndarray, b: np.ndarray) -> float:
    """The product of two vectors by one thread, as those of BLAS wait for each other at the cost of CPU time."""
    return float(np.einsum("i,i", a, b))


def minimised(value_and_slope, w: np.ndarray, steps: int, memory: int = 6, least_fall: float = 1e-5) -> np.ndarray:
    """The minimum of a smooth convex function, by L-BFGS with halved steps. It ends when STEADY steps together fall by less than least_fall of the value."""
    value, slope = value_and_slope(w)
    values = [value]
    past: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(steps):
        way, parts = slope.copy(), []
        for s, y, rho in reversed(past):
            parts.append(rho * _dot(s, way))
            way -= parts[-1] * y
        if past:
            way *= 1 / (past[-1][2] * _dot(past[-1][1], past[-1][1]))
        for (s, y, rho), part in zip(past, reversed(parts), strict=True):
            way += s * (part - rho * _dot(y, way))
        fall, size = _dot(slope, way), 1.0 if past else min(1.0, 1.0 / max(np.abs(slope).max(), 1e-12))
        while True:
            new_value, new_slope = value_and_slope(w - size * way)
            if new_value <= value - 1e-4 * size * fall or size < 1e-6:
                break
            size /= 2
        s, y = -size * way, new_slope - slope
        if _dot(s, y) > 1e-12:
            past = [*past, (s, y, 1 / _dot(s, y))][-memory:]
        w, value, slope = w + s, new_value, new_slope
        values.append(value)
        if fall <= 0 or len(values) > STEADY and values[-1 - STEADY] - value < least_fall * max(value, 1e-9):
            break
    return w


class _Fit:
    """Independent logistic regressions of the labels over the features that occur twice or more.

    Equal rows of one label count as one of their common weight, features of the same rows as one of the length of them all.
    """

    def __init__(self, row: np.ndarray, feature: np.ndarray, labels: np.ndarray, times: np.ndarray):
        self.row, self.feature, self.labels, self.times, self.parts = row, feature, labels, times, []
        seen = np.bincount(feature, weights=times[row], minlength=DIMENSIONS)
        for wide in (DIMENSIONS, PAIR_DIMENSIONS):
            used = (seen > 1) & (np.arange(DIMENSIONS) < wide)
            place, keep = np.cumsum(used) - 1, used[feature]
            r, f, m = row[keep], place[feature[keep]], int(used.sum())
            one, of_row = _alike(r, f, len(labels), labels + 1)
            mine = one[r]
            r, f = of_row[r[mine]], f[mine]
            one, of_feature = _alike(f, r, m, np.zeros(m, np.int64))
            mine = one[f]
            r, f = r[mine], of_feature[f[mine]]
            label = np.zeros(of_row.max(initial=-1) + 1, np.int64)
            label[of_row] = labels
            by_row, by_feature = _order(r), _order(f)
            rows, row_starts = _runs(r[by_row])
            feature_starts = _runs(f[by_feature])[1]
            self.parts.append((used, of_row, of_feature, label, rows, f[by_row], row_starts, r[by_feature], feature_starts))

    def weights(self, kept: np.ndarray, share: float, steps: int, ridge: float = 2e-6, start: np.ndarray | None = None, least_fall: float = LEAST_FALL) -> np.ndarray:
        """Weights (label, feature) by the rows kept for each label. The pairs of a label weigh at least `share` of all others.

        start: weights to begin from, such as those of a fit with nearly the same rows. Features are scaled by the fourth root of
        their weight, between none and full scaling by curvature: the minimum is the same and reached in fewer steps.
        """
        out = np.zeros((len(LABELS), DIMENSIONS), np.float32)
        for k, sound in enumerate(kept):
            used, of_row, of_feature, label, rows, features_by_row, row_starts, rows_by_feature, feature_starts = self.parts[k in PAIR_LABELS]
            counts = self.times * sound
            n = counts.sum()
            if not n or not len(of_feature):
                continue
            target = (self.labels == k) & sound
            mine = counts[target].sum()
            balance = np.where(target, max(1.0, share * (n - mine) / max(mine, 1)), 1.0) * counts / n
            if k == 4:  # refusals and placeholders come in any language and say nothing on whether it is the right one
                balance[(self.labels == 2) | (self.labels == 0)] = 0
            weight, hit = np.bincount(of_row, weights=balance), (label == k).astype(np.float64)
            alike = np.bincount(of_feature)
            wide = k not in PAIR_LABELS  # the others have few features, and their steps cost next to nothing
            scale = (np.add.reduceat(weight.take(rows_by_feature), feature_starts) * alike / 4 + 1e-4) ** -0.25 if wide else np.ones(len(alike))
            length = np.sqrt(alike) * scale

            def loss(w: np.ndarray) -> tuple[float, np.ndarray]:
                z = np.zeros(len(hit))
                z[rows] = np.add.reduceat((w * length).take(features_by_row), row_starts)  # noqa: B023
                e = np.exp(-np.abs(z))
                p = np.where(z >= 0, 1, e) / (1 + e)
                own = w * scale  # noqa: B023
                value = _dot(weight, np.log1p(e) + np.maximum(z, 0) - hit * z) + ridge / 2 * _dot(own, own)  # noqa: B023
                return value, np.add.reduceat(((p - hit) * weight).take(rows_by_feature), feature_starts) * length + ridge * own * scale  # noqa: B023

            began = np.zeros(len(length)) if start is None else np.bincount(of_feature, weights=start[k, used]) / length
            out[k, used] = (minimised(loss, began, steps, least_fall=least_fall if wide else 1e-5) * scale / np.sqrt(alike))[of_feature]
        return out


def _order(x: np.ndarray) -> np.ndarray:
    """The stable order of small whole numbers, by their halves of 16 bits."""
    by = np.argsort((x & 0xFFFF).astype(np.uint16), kind="stable")
    return by if x.max(initial=0) < 1 << 16 else by[np.argsort((x[by] >> 16).astype(np.uint16), kind="stable")]


def _runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(value, start) of the runs of equal numbers."""
    starts = np.flatnonzero(np.diff(x, prepend=-1))
    return x[starts], starts


def _alike(of: np.ndarray, holds: np.ndarray, n: int, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of n sets, given as pairs (set, member), whether each is the first of its equals, and the number of its class; sets of two kinds differ."""
    salt = mix(np.arange(holds.max(initial=0) + 1, dtype=np.uint64) + np.uint64(1))
    key = mix(kind.astype(np.uint64) + np.uint64(7))
    for part in (salt >> np.uint64(32), salt & np.uint64(0xFFFFFFFF)):  # sums of a million of them are exact
        key = mix(key ^ mix(np.bincount(of, weights=part.astype(np.float64)[holds], minlength=n).astype(np.uint64)))
    _, first, number = np.unique(key, return_index=True, return_inverse=True)
    one = np.zeros(n, bool)
    one[first] = True
    return one, number


def _scores(row: np.ndarray, feature: np.ndarray, n: int, weights: np.ndarray) -> np.ndarray:
    """Scores (label, row). Labels judged by features of the pair have weights on no others."""
    paired = np.flatnonzero(feature < PAIR_DIMENSIONS)
    some = [(row[paired], feature[paired]) if k in PAIR_LABELS else (row, feature) for k in range(len(LABELS))]
    return np.stack([np.bincount(r, weights=weights[k].take(f), minlength=n) for k, (r, f) in enumerate(some)])


@dataclass(frozen=True)
class Languages:
    weights: np.ndarray  # (language, word bucket): log-odds
    known: np.ndarray  # (language, word bucket): whether the language has such words


@dataclass(frozen=True)
class Model:
    languages: Languages
    weights: np.ndarray
    thresholds: np.ndarray
    shares: dict[str, float]  # estimated share of rows with the defect

    def defects(self, question: pa.Array, answer: pa.Array) -> np.ndarray:
        """Index into LABELS of each pair, -1 for none: of the labels above their thresholds the likeliest. A clear refusal or placeholder in another language is that."""
        row, feature = features(question, answer, self.languages)
        score = _scores(row, feature, len(answer), self.weights)
        over = score - self.thresholds[:, None]
        over[4] = np.where(((score[[0, 2]] > 0) & (over[[0, 2]] > 0)).any(0), -1, over[4])
        best = np.where(over > 0, score, -np.inf).argmax(0)
        return np.where(over[best, np.arange(len(answer))] > 0, best, -1)


@functools.cache
def _common_words() -> tuple[np.ndarray, np.uint64, np.ndarray, np.ndarray]:
    """(hashes of the common words, shift, place of the hash by 16 bits from the shift on, whether a language has it)."""
    hashes = [Words(pa.array(sorted(v), pa.string())).hashes for v in _COMMON_SETS.values()]
    every = np.unique(np.concatenate(hashes))
    shift = next(k for k in range(49) if len(np.unique(every >> np.uint64(k) & np.uint64(0xFFFF))) == len(every))
    place = np.zeros(1 << 16, np.int64)
    place[every >> np.uint64(shift) & np.uint64(0xFFFF)] = np.arange(len(every))
    return every, np.uint64(shift), place, np.stack([np.isin(every, h) for h in hashes])


def tongues_of(side: _Side) -> np.ndarray:
    """The language() of every text, as index into COMMON, -1 for none."""
    every, shift, place, has = _common_words()
    word = place[side.exact >> shift & np.uint64(0xFFFF)]
    common = np.flatnonzero(every[word] == side.exact)
    row, word = side.row[common], word[common]
    held = np.stack([np.bincount(row[mine[word]], minlength=side.n_rows) for mine in has])
    top = np.sort(held, axis=0)
    return np.where(top[-1] > np.maximum(1, top[-2]), held.argmax(0), -1)


def count_languages(question: pa.Array, answer: pa.Array) -> tuple[np.ndarray, np.ndarray, int]:
    """(language, word bucket) how often words occur and in how many texts, and the number of texts; sums over parts of a table are those of the table.

    Texts are labelled by their common words; an answer without any, such as a list of figures, goes by its question.
    """
    counts = np.zeros((len(_LANGUAGES), LANGUAGE_DIMENSIONS), np.int64)
    texts = np.zeros((len(_LANGUAGES), LANGUAGE_DIMENSIONS), np.int64)
    q, a = _Side(question), _Side(answer)
    of_q, of_a = tongues_of(q), tongues_of(a)
    for side, labels in ((q, of_q), (a, np.where(of_a >= 0, of_a, of_q))):
        at = (side.shape % np.uint64(LANGUAGE_DIMENSIONS)).astype(np.int64)
        mine = labels[side.row] >= 0
        row, at = side.row[mine], at[mine]
        counts += np.bincount(labels[row] * LANGUAGE_DIMENSIONS + at, minlength=counts.size).reshape(counts.shape)
        once = np.sort(row * LANGUAGE_DIMENSIONS + at)
        once = once[np.diff(once, prepend=-1) > 0]
        texts += np.bincount(labels[once // LANGUAGE_DIMENSIONS] * LANGUAGE_DIMENSIONS + once % LANGUAGE_DIMENSIONS, minlength=texts.size).reshape(texts.shape)
    return counts, texts, 2 * len(question)


def languages_of(counts: np.ndarray, texts: np.ndarray, n_texts: int) -> Languages:
    """Naive Bayes log-odds of words by language, and which words a language has."""
    # Words rarer than one in five thousand say little: a name must not count for the language it happened to occur in.
    size = counts.sum(1)
    rate = counts / np.maximum(size[:, None], 1)
    there = size >= max(500, PRESENT_SHARE * size.sum())
    rate[~there] = 0  # a language with next to no text is none of this table
    present = np.maximum(there.sum(), 1)
    return Languages(np.log((rate + 2e-4) / (rate.sum(0) / present + 2e-4)), texts > max(2, KNOWN_SHARE * n_texts))


def _columns(pairs: list[tuple[str, str]]) -> tuple[pa.Array, pa.Array]:
    return tuple(pa.array([p[i] for p in pairs], pa.string()) for i in (0, 1))


def fit_languages(pairs: list[tuple[str, str]]) -> Languages:
    return languages_of(*count_languages(*_columns(pairs)))


def expected_share(scores: np.ndarray, trained: float, turns: int = 60, times: np.ndarray | None = None) -> float:
    """The share of rows with a defect, by expectation maximisation over log-odds that were learned at another share. times: how often each score occurs."""
    share, at = 0.05, np.log(trained / (1 - trained))
    for _ in range(turns):
        shift = np.log(share / (1 - share)) - at
        share = float(np.clip(np.average(1 / (1 + np.exp(-np.clip(scores + shift, -30, 30))), weights=times), LEAST_SHARE, 0.5))
    return share


def parting(scores: np.ndarray, even: float, times: np.ndarray | None = None) -> float:
    """The middle of the widest gap between the tenth of greatest scores, up to `even`; `even` itself where none is wider than 1.

    In a gap lie no more than LEAST_SHARE of all scores. Of gaps about as wide the lowest counts, as a wording of its own may lie
    between two. times: how often each score occurs.
    """
    order = np.argsort(scores)
    scores, times = scores[order], np.ones(len(scores), np.int64) if times is None else times[order]
    upto = np.cumsum(times)
    near = (upto > 0.9 * upto[-1]) & (scores < even) if len(scores) else np.zeros(0, bool)
    # From each of them the gap ends at the first with more than the few behind the one it begins at; all beyond `even` are at it.
    begin, upto = np.append(scores[near], even), np.append(upto[near], np.iinfo(np.int64).max)
    few = int(LEAST_SHARE * times.sum())
    end = np.searchsorted(upto, upto[:-1] + few, side="right")
    gaps = begin[end] - begin[:-1]
    if not len(gaps) or gaps.max() < 1:
        return float(even)
    wide = np.flatnonzero(gaps >= 0.75 * gaps.max())
    wide = wide[begin[wide] < begin[end[wide[0]]]]  # the lowest one and those that overlap it
    at = wide[gaps[wide].argmax()]
    return float((begin[at] + begin[end[at]]) / 2)


def thresholds_of(scores: list[np.ndarray], times: list[np.ndarray] | None = None) -> tuple[np.ndarray, dict[str, float]]:
    """(threshold of each label, estimated share of each) from the scores of pairs by weights that these pairs did not teach.

    Nothing is assumed on how frequent a defect is: its share is estimated from the scores. The threshold is where a pair is as
    likely sound as not at that share, or the middle of the gap that parts the scores below it.
    """
    out, shares, learned = np.zeros(len(LABELS)), {}, TRAIN_SHARE / (1 + TRAIN_SHARE)
    for k, name in enumerate(LABELS):
        weight = times[k] if times else None
        if not len(scores[k]):
            continue
        shares[name] = expected_share(scores[k], learned, times=weight)
        even = np.log(learned / (1 - learned)) - np.log(shares[name] / (1 - shares[name]))
        out[k] = parting(scores[k], even, weight)
    return out, shares


def _part(keep: np.ndarray, row: np.ndarray, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The features of the rows to keep, numbered anew."""
    mine = keep[row]
    return (np.cumsum(keep) - 1)[row[mine]], feature[mine]


def _made_features(side: _Side, answers: list[str], languages: Languages, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The features of many answers, some at a time, as small arrays stay in the caches."""
    answer, parts = pa.array(answers, pa.string()), []
    for start, stop in row_slices(byte_sizes(answer) + 100, BATCH_BYTES // 2):
        mine = of[start:stop]
        some, place = np.unique(mine, return_inverse=True)
        row, feature = features(side.part(some), answer.slice(start, stop - start), languages, place)
        parts.append((row + start, feature))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.empty(0, np.int64), np.empty(0, np.int64))


def fit_block(pairs: list[tuple[str, str]], languages: Languages, seed: int = 11, families: tuple[str, ...] = tuple(REFUSALS)) -> tuple[np.ndarray, np.ndarray]:
    """(weights, how often each feature occurs) from pairs. Pairs that a first fit finds defective do not stand for sound ones in the last."""
    rng = random.Random(seed)
    pairs = sorted(pairs)
    rng.shuffle(pairs)
    half = len(pairs) // 2
    halves = []
    for some, salt in ((pairs[:half], 3), (pairs[half:], 7)):
        side = _Side(_columns(some)[0])
        _, answers, labels, sources, times = made_of(some, seed + salt, families, side)
        row, feature = _made_features(side, answers, languages, sources[:, 0])
        first = np.ones(len(labels), bool)  # the pairs as they came
        first[1:] = sources[1:, 0] != sources[:-1, 0]
        halves.append((len(some), _Fit(row, feature, labels, times), sources, _part(first, row, feature)))

    # Each half is cleaned by what the other half teaches, as a model excuses the defects that it was taught as sound. The pairs most
    # like a worded defect do not teach that one, whatever their score, as wordings never made here are taught as sound in both.
    sound = [np.ones((len(LABELS), n), bool) for n, *_ in halves]
    taught = [None, None]
    for _ in range(3):  # each fit goes on from the last one
        taught = [x.weights(keep[:, sources].all(2), 1.0, 20, start=last, least_fall=CLEANING_FALL) for (_, x, sources, _), keep, last in zip(halves, sound, taught, strict=True)]
        for i, (n, *_, came) in enumerate(halves):
            score = _scores(*came, n, taught[1 - i])
            sound[i] = np.tile((score <= -2).all(0), (len(LABELS), 1))
            for k in WORDED_LABELS if n else ():
                sound[i][k] &= score[k] <= np.quantile(score[k], 1 - SET_ASIDE)
    (_, x, _, _), (_, y, _, _) = halves
    both = _Fit(np.concatenate([x.row, y.row + len(x.labels)]), np.concatenate([x.feature, y.feature]), np.concatenate([x.labels, y.labels]), np.concatenate([x.times, y.times]))
    kept = np.concatenate([keep[:, sources].all(2) for keep, (_, _, sources, _) in zip(sound, halves, strict=True)], axis=1)
    seen = np.bincount(both.feature, weights=(both.times * kept.any(0))[both.row], minlength=DIMENSIONS).astype(np.int64)
    return both.weights(kept, TRAIN_SHARE, 60, start=(taught[0] + taught[1]) / 2), seen


def fit(pairs: list[tuple[str, str]], seed: int = 11, families: tuple[str, ...] = tuple(REFUSALS)) -> Model:
    """The model from a list of pairs: half of them are fitted as one block, the others give the thresholds."""
    languages = fit_languages(pairs)
    pairs = sorted(pairs)
    random.Random(seed).shuffle(pairs)
    held = pairs[: len(pairs) // 2]
    weights, _ = fit_block(pairs[len(pairs) // 2 :], languages, seed, families)
    return Model(languages, weights, *thresholds_of(_scores(*features(*_columns(held), languages), len(held), weights)))


def _summed(rows: DataFrame, size: int, wide: int, total_of: Callable[[Iterator[pa.RecordBatch]], np.ndarray]) -> np.ndarray:
    """The sum of the arrays (size, wide) of whole numbers that total_of makes of each partition."""
    names = ["at", *(f"n{k}" for k in range(wide))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = total_of(batches)
        at = np.flatnonzero(total.any(1))
        for start in range(0, len(at), 1 << 16):
            some = at[start : start + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(some), *(pa.array(total[some, k]) for k in range(wide))], names=names)

    sums = rows.mapInArrow(run, ", ".join(f"{k} long" for k in names)).groupBy("at").agg(*[F.sum(k).alias(k) for k in names[1:]]).toArrow()
    out = np.zeros((size, wide), np.int64)
    out[sums["at"].to_numpy()] = np.stack([sums[k].to_numpy() for k in names[1:]], axis=1)
    return out


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, stop in row_slices(byte_sizes(batch["question"], batch["answer"]), BATCH_BYTES):
            yield batch.slice(start, stop - start)


def train(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> Model:
    """The model of all rows that have both texts, one of each question and answer.

    Blocks of pairs, by their hash, are fitted apart; a weight is the mean over the blocks, each counting as often as the feature
    occurs in it. Blocks of even and of odd numbers give a model each, by which the pairs of the others are scored for the thresholds.
    """
    spark = rows.sparkSession
    cuts = Cuts(spark, "defects")
    pairs = cuts.cut(rows.where("question is not null and answer is not null").select("question", "answer").distinct())
    n, chars = pairs.agg(F.count("*"), F.coalesce(F.sum(F.length("question") + F.length("answer")), F.lit(0))).first()
    blocks = 2 * max(1, math.ceil(n / block_rows / 2), math.ceil(chars / BLOCK_CHARS / 2))
    pairs = pairs.withColumn("block", F.pmod(F.xxhash64("question", "answer"), F.lit(blocks)))

    def counted(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros((2, len(_LANGUAGES), LANGUAGE_DIMENSIONS), np.int64)
        for part in _slices(batches):
            total += count_languages(part["question"], part["answer"])[:2]
        return total.reshape(2, -1).T

    counts, texts = _summed(pairs, len(_LANGUAGES) * LANGUAGE_DIMENSIONS, 2, counted).T.reshape(2, len(_LANGUAGES), LANGUAGE_DIMENSIONS)
    languages = spark.sparkContext.broadcast(languages_of(counts, texts, 2 * n))

    def fitted(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros((2, DIMENSIONS, 1 + len(LABELS)), np.int64)
        rows = (x for batch in batches for x in zip(batch["block"].to_pylist(), zip(batch["question"].to_pylist(), batch["answer"].to_pylist(), strict=True), strict=True))
        for block, of_block in itertools.groupby(rows, key=lambda x: x[0]):
            weights, seen = fit_block([x for _, x in of_block], languages.value)
            total[block % 2, :, 0] += seen
            total[block % 2, :, 1:] += np.rint(weights.T * seen[:, None].astype(np.float64) * GRID).astype(np.int64)
        return total.reshape(2 * DIMENSIONS, -1)

    tasks = 2 * math.ceil(max(min(blocks, 4 * spark.sparkContext.defaultParallelism), blocks / TASK_BLOCKS) / 2)
    by_block = pairs.repartitionById(tasks, F.pmod("block", F.lit(tasks)).cast("int")).sortWithinPartitions("block")
    sums = _summed(by_block, 2 * DIMENSIONS, 1 + len(LABELS), fitted).reshape(2, DIMENSIONS, -1).astype(np.float64)
    mean = lambda x: np.ascontiguousarray((x[..., 1:] / GRID / np.maximum(x[..., :1], 1)).swapaxes(-1, -2).astype(np.float32))
    of_fold = spark.sparkContext.broadcast(mean(sums))

    def scored(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros(len(LABELS) * BINS, np.int64)
        for part in _slices(batches):
            row, feature = features(part["question"], part["answer"], languages.value)
            other = 1 - part["block"].to_numpy() % 2
            fold = [_scores(row, feature, part.num_rows, w) for w in of_fold.value]
            for k, score in enumerate(np.where(other, fold[1], fold[0])):
                total += np.bincount(k * BINS + np.clip(np.rint(score / BIN).astype(np.int64) + BINS // 2, 0, BINS - 1), minlength=len(total))
        return total[:, None]

    times = _summed(pairs, len(LABELS) * BINS, 1, scored).reshape(len(LABELS), BINS)
    cuts.drop(pairs)
    held = [np.flatnonzero(x) for x in times]
    return Model(languages.value, mean(sums.sum(0)), *thresholds_of([(x - BINS // 2) * BIN for x in held], [x[at] for x, at in zip(times, held, strict=True)]))


def broken_pairs(rows: DataFrame, model: Model, key: str = "record_number") -> DataFrame:
    """(key, defect) of the rows with a defect, one each. Null texts read as empty; other columns are ignored."""
    sent = rows.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([rows.schema[key], T.StructField("defect", T.StringType())])
    names = np.array([*LABELS, None], object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in batches:
            for start, stop in row_slices(byte_sizes(batch.column(1), batch.column(2)), BATCH_BYTES):
                part = batch.slice(start, stop - start)
                found = m.defects(part.column(1), part.column(2))
                hit = np.flatnonzero(found >= 0)
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(hit)), pa.array(names[found[hit]], pa.string())], names=schema.names)

    return rows.select(key, F.coalesce("question", F.lit("")).alias("question"), F.coalesce("answer", F.lit("")).alias("answer")).mapInArrow(run, schema)
