"""Broken prompt and response pairs (problem 6).

A response is cut into clauses and a linear-chain conditional random field tags every clause as answer, refusal, echo,
foreign or unfinished. The coverage of the response by its tags gives the pair's one defect. Responses without content
have none to tag and are empty.

The field sees a clause by what it shares and what it brings. Words of the question make an echo; figures and words of
the passage that the question lacks are content. What is left, the *loose* words, is judged by models estimated from the
corpus and a list of sentences that decline: how many of them are familiar in the language of the question, how many of
their letter triples are, which script they are in, and how much likelier they are where somebody declines. A refusal
in a language that nothing here knows is thus unfamiliar and brings nothing, an answer in such a language is unfamiliar
and brings the passage's figures or names.

The field is trained here, on pairs of the corpus that are damaged on purpose, so every clause's tag is known. Pairs that
a first field takes for damaged already are left out of the second.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import spread_sample, table
from .truncation import answer_verdicts, content

TAGS = ("answer", "refusal", "echo", "foreign", "unfinished")
ANSWER, REFUSAL, ECHO, FOREIGN, UNFINISHED = range(5)
#: Pairs the field is trained on at most, chosen by a hash of their ids. All pairs are judged.
MAX_TRAINING_PAIRS = 3000
MAX_TRAINING_CHARS = 8000

# Common words by language, none of which is a word of another language listed here in lower case.
FUNCTION_WORDS = {
    "en": "the of and to was is for were that which its by at from with this it be been not an are than before after year what how did does whether would both between on has have their while because there they she you if but had out about into only other then when who could should may might just each every any some such these those through during until since",
    "es": "el los las del una con por según y fue había durante la en que cuánto qué cuál como para se su ejercicio año cifra informe",
    "de": "der die das und von für war wie lag den dem ein einen eine am im nach auf bei weil während noch sich laut zum zur nicht welcher wert betrag jahr",
    "fr": "le les des du et une dans pour était sur au aux est car selon quel quelle qui plus contre il l'exercice montant rapport année",
    "it": "il lo gli della dell nello alla rispetto era pari poiché secondo sono anno di relazione importo che nella è stato",
    "pt": "o os as da do na no em foi segundo porque não contra ano registou valor relatório pelo uma ao",
    "nl": "het de een van op bedroeg volgens omdat tegenover jaar eerder boekte verslag bedrag locatie niet deze",
    "pl": "w i na z wobec rok był kwota według raportu ponieważ wyniosła zakładzie wcześniej nie się wykazał oraz",
}
_LANGUAGES = list(FUNCTION_WORDS)
_BY_WORD: dict[str, list[int]] = {}
for _i, _name in enumerate(_LANGUAGES):
    for _w in FUNCTION_WORDS[_name].split():
        _BY_WORD.setdefault(_w, []).append(_i)
_COMMON = frozenset(_BY_WORD)

_REPORT_GATE = ('"', "“", "«", "„", "”", "»", "stated", "says", "said", "management", "the company", "the board", "the registrant", "the chair", "the filing", "it refused", "it declined", "request was", "declined the", "in the words", "turned ", "we ")
# How a statement of the company is reported.
_REPORTED = re.compile(r"^[\"“«„]|[\"”»],? (?:the|said)|\b(?:stated|says|said|management|the (?:company|board|registrant|chair|filing)|it (?:refused|stated|declined)|request was|declined the|in the words|turned .* down|we (?:cannot|do not|are unable))\b", re.IGNORECASE)
_AMOUNT = re.compile(r"[$€£]\s?\(?\d|\d\s?(?:%|percent|million|thousand|billion)|\d,\d{3}")
_UNITS = frozenset(["million", "thousand", "billion", "percent"])  # fixed values: parts of amounts, which have no language
_CLAUSE = re.compile(r"(?<=[.!?;。])[\"”»)\]]*\s+")
_LEAD = re.compile(r"^(?:answer|antwort|respuesta|réponse|question|q|a)\s*[:.]\s*", re.IGNORECASE)
_WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)*")
_BLANKED = bytes(i if chr(i).isalnum() and i < 128 else 32 for i in range(256))

N_FEATURES = 59
_WEIGHT_OF_UNSEEN = 0.5  # added to the counts of words, for those that were never met
_LOST = 3  # place of the feature that says that the last clause lost its end


def _written(text: str) -> list[str]:
    """What ``_WORD`` finds, without a search where words are plain."""
    if text.isascii() and "'" not in text:
        return text.encode().translate(_BLANKED).decode().split()
    return _WORD.findall(text)


def _script(text: str) -> str:
    """Script of most letters, by the names that Unicode gives them; empty without letters."""
    far = [c for c in text if c >= "\u0250" and c.isalpha()]
    counts = Counter(map(_script_of, far))
    counts["LATIN"] += sum(map(str.isalpha, text)) - len(far)
    script, n = counts.most_common(1)[0]
    return script if n else ""


@lru_cache(maxsize=20_000)
def _script_of(c: str) -> str:
    name = unicodedata.name(c, "").split(" ")[0].split("-")[0]
    return "EAST" if name in ("CJK", "HIRAGANA", "KATAKANA", "HANGUL") else name


@dataclass
class Prompt:
    """What clauses of a response are compared with."""

    words: frozenset[str]
    language: int
    script: str = ""
    passage: frozenset[str] = frozenset()

    @cached_property
    def letters(self) -> frozenset[str]:
        """Sorted letters of each word, to know words with letters exchanged."""
        return frozenset("".join(sorted(w)) for w in self.words)


def _hits(words: set[str]) -> list[int]:
    counts = [0] * len(_LANGUAGES)
    for w in words & _COMMON:
        for i in _BY_WORD[w]:
            counts[i] += 1
    return counts


def prompt_of(question: str, passage: str = "") -> Prompt:
    written = set(_written(question))
    words = frozenset(map(str.lower, written))
    counts = _hits(written if any(w[0].islower() for w in written) else words)
    best = max(counts)
    return Prompt(words, counts.index(best) if best else -1, "LATIN" if question.isascii() and words else _script(question), frozenset(_written(passage.lower())))


def clauses(text: str) -> list[str]:
    out = [c for c in (x.strip() for x in _CLAUSE.split(_LEAD.sub("", text, count=1))) if _WORD.search(c)]
    return out or [text]


def _triples(word: str) -> list[str]:
    marked = f"^{word}$"
    return [marked[i : i + 3] for i in range(len(marked) - 2)]


def _pieces(word: str) -> tuple[str, ...]:
    """A word, and its beginning, which stands for forms of it that were never met."""
    return (word, "^" + word[:5]) if len(word) > 5 else (word,)


class Lexicon:
    """What is known of words: by language which are familiar, and how likely they are where somebody declines."""

    LIMIT = 200_000

    def __init__(self, texts: list[tuple[int, str]], refusals: list[list[str]], answers: list[list[str]]):
        """``texts`` with their languages; loose words of sentences that decline, and of answers."""
        met = [Counter() for _ in _LANGUAGES]
        for language, text in texts:
            if language >= 0:
                met[language].update({w.lower() for w in _written(text) if w.isalpha()})
        self.familiar = [frozenset(w for w, n in c.items() if n >= 2) | frozenset(FUNCTION_WORDS[name].split()) for c, name in zip(met, _LANGUAGES)]
        self.triples = [frozenset(t for w in known for t in _triples(w)) for known in self.familiar]
        self.folds = [[words for i, words in enumerate(refusals) if i % FOLDS != f] for f in range(FOLDS)]
        said = Counter(x for words in answers for w in set(words) for x in _pieces(w))
        self.ratios = [_log_ratios(fold, said, len(answers)) for fold in [*self.folds, refusals]]
        self._memo: dict[tuple[int, str], tuple[bool, float]] = {}

    def known(self, language: int, word: str) -> tuple[bool, float]:
        """Whether a word is familiar in a language, and the share of its letter triples that are."""
        key = (language, word)
        found = self._memo.get(key)
        if found is None:
            if len(self._memo) >= self.LIMIT:
                self._memo.clear()
            parts = _triples(word)
            found = self._memo[key] = (word in self.familiar[language], sum(t in self.triples[language] for t in parts) / len(parts))
        return found


def _log_ratios(refusals: list[list[str]], said: Counter[str], n_answers: int) -> dict[str, float]:
    declined = Counter(x for words in refusals for w in set(words) for x in _pieces(w))
    total, others = len(refusals) + 2 * _WEIGHT_OF_UNSEEN, n_answers + 2 * _WEIGHT_OF_UNSEEN
    return {w: float(np.log((declined[w] + _WEIGHT_OF_UNSEEN) / total) - np.log((said[w] + _WEIGHT_OF_UNSEEN) / others)) for w in declined.keys() | said.keys()}


def _pull(ratio: dict[str, float], word: str) -> float:
    """How much likelier a word, or its beginning, is where somebody declines; the surer of both."""
    own = ratio.get(word, 0.0)
    if len(word) <= 5:
        return own
    begun = ratio.get("^" + word[:5], 0.0)
    return begun if abs(begun) > abs(own) else own


def loose_words(prompt: Prompt, clause: str) -> list[str]:
    """Words in lower case that stand neither in the question nor in the passage; names are left out."""
    out = []
    for i, w in enumerate(_written(clause)):
        low = w.lower()
        if w.isalpha() and low not in prompt.words and low not in prompt.passage and low not in _UNITS and (i == 0 or not w[0].isupper()):
            out.append(low)
    return out


def features(prompt: Prompt, clause: str, first: bool, last: bool, lost: bool, lexicon: Lexicon, fold: int = -1) -> list[float]:
    """One number for each of the ``N_FEATURES`` features of a clause. ``fold`` leaves out what was learnt from that part of the refusals."""
    written = _written(clause)
    words = [w.lower() for w in written]
    n = max(1, len(words))
    known = [w in prompt.words for w in words]
    inside = sum(known) / n
    if 0.5 <= inside < 1:  # an echo with slips, perhaps
        known = [k or "".join(sorted(w)) in prompt.letters for w, k in zip(words, known)]
        inside = sum(known) / n
    covered = len(prompt.words.intersection(words) if inside < 0.5 or inside == 1 else {w for w, k in zip(words, known) if k}) / max(1, len(prompt.words))
    fresh_number, brought, loose = False, 0, []
    for i, (w, low, k) in enumerate(zip(written, words, known)):
        if k:
            continue
        if not low.isalpha():
            fresh_number = fresh_number or any(c.isdigit() for c in low)
            brought += low in prompt.passage
        elif low in prompt.passage:
            brought += len(low) > 3 and low not in _BY_WORD
        elif low not in _UNITS and (i == 0 or not w[0].isupper()):
            loose.append(low)
    # Names don't tell the language: prose is what is written in lower case, so words count as they are written.
    counts = _hits({*written, *words[:1]})
    language = prompt.language
    own = counts[language] if language >= 0 else 0
    other = max(counts[:language] + counts[language + 1 :]) if language >= 0 else 0
    m = len(loose)
    found = [lexicon.known(language, w) for w in loose] if language >= 0 else []
    strange = sum(not f for f, _ in found)
    triples = sum(t for f, t in found if not f) / strange if strange else 1.0
    ratio = lexicon.ratios[fold]
    said = [_pull(ratio, w) for w in loose]
    pull, top = sum(said), max(said) if said else 0.0
    mean = pull / m if m else 0.0
    foreign_script = bool(prompt.script) and not clause.isascii() and (script := _script(clause)) != "" and script != prompt.script
    amount = bool(_AMOUNT.search(clause))
    content_ = amount or fresh_number or brought > 0
    low = clause.lower()
    reported = False
    for x in _REPORT_GATE:
        if x in low:
            reported = bool(_REPORTED.search(clause))
            break
    listed = other >= 2 and other > own
    odd = m >= 3 and strange >= 0.8 * m and own < 2
    unknown = foreign_script or (odd and triples < 0.75)
    return [
        1, first, last, lost and last, n <= 3, n > 12,
        inside >= 0.95, 0.8 <= inside < 0.95, inside < 0.6, covered >= 0.6, 0.4 <= covered < 0.6, covered < 0.4, (inside >= 0.85) and covered >= 0.5, fresh_number,
        inside >= 0.8 and covered >= 0.55 and not fresh_number,
        listed, other >= 3 and own == 0, own >= 2, other >= 2 and own == 0 and n > 3, other == own == 0,
        mean > 0.5, mean > 1.5, mean > 2.5, pull > 3, pull > 6, pull > 10, pull > 15, min(max(pull, 0.0), 40.0) / 10, mean > 1.5 and pull > 6 and not reported, pull < -2 and not (unknown or listed), top > 2.5, mean > 1 and not content_, pull > 4 and not content_, mean > 1 and reported, pull > 3 and amount,
        content_, brought > 0, amount, reported, m == 0, not content_ and m > 0 and strange == m, not content_ and inside > 0, not content_ and n <= 3 and inside == 0, not content_ and m == n and strange == m and not unknown, not content_ and strange == 0 and language >= 0,
        strange >= 2 and strange == m, odd, unknown, odd and triples < 0.65, odd and triples < 0.55, odd and triples < 0.45, odd and own == 0, odd and own == 0 and m >= 5, strange >= 6 and strange >= 0.7 * m and own <= 1, foreign_script,
        (unknown or listed) and content_, (unknown or listed) and not content_, listed and mean > 1.5, foreign_script and not content_,
    ]


@dataclass
class ChainField:
    """Linear-chain conditional random field over clause features."""

    emission: np.ndarray  # (features, tags)
    transition: np.ndarray  # (tags, tags)

    def tag(self, clauses_: np.ndarray, lengths: list[int]) -> list[np.ndarray]:
        """Most likely tags of each sequence of clauses, by Viterbi; sequences stand one after another."""
        scores = clauses_ @ self.emission
        scores[clauses_[:, _LOST] == 0, UNFINISHED] = -1e9  # only a lost end leaves a clause unfinished
        best = scores.argmax(axis=1)
        out, at = [], 0
        for n in lengths:
            out.append(best[at : at + 1] if n == 1 else self._viterbi(scores[at : at + n].copy()))
            at += n
        return out

    def _viterbi(self, score: np.ndarray) -> np.ndarray:
        back = np.zeros(score.shape, np.int64)
        for t in range(1, len(score)):
            step = score[t - 1][:, None] + self.transition
            back[t] = step.argmax(axis=0)
            score[t] += step.max(axis=0)
        tags = np.zeros(len(score), np.int64)
        tags[-1] = score[-1].argmax()
        for t in range(len(score) - 1, 0, -1):
            tags[t - 1] = back[t][tags[t]]
        return tags


def _log_sum(a: np.ndarray, axis: int) -> np.ndarray:
    most = a.max(axis=axis, keepdims=True)
    return np.squeeze(most, axis) + np.log(np.exp(a - most).sum(axis=axis))


def fit(sequences: list[np.ndarray], tags: list[list[int]], rounds: int = 150, rate: float = 0.1, penalty: float = 1e-3) -> ChainField:
    """Maximum likelihood by Adam, all sequences of one length at once."""
    k = len(TAGS)
    by_length: dict[int, list[int]] = {}
    for i, x in enumerate(sequences):
        by_length.setdefault(len(x), []).append(i)
    groups = [(np.stack([sequences[i] for i in at]), np.array([tags[i] for i in at])) for at in by_length.values()]
    total = max(1, len(sequences))
    weights = [np.zeros((N_FEATURES, k)), np.zeros((k, k))]
    moments = [[np.zeros_like(w), np.zeros_like(w)] for w in weights]
    for turn in range(1, rounds + 1):
        grads = [-penalty * total * w for w in weights]
        for x, y in groups:
            score = x @ weights[0]
            length = x.shape[1]
            ahead, behind = [score[:, 0]], [np.zeros_like(score[:, 0])]
            for t in range(1, length):
                ahead.append(_log_sum(ahead[-1][:, :, None] + weights[1], 1) + score[:, t])
            for t in range(length - 2, -1, -1):
                behind.append(_log_sum(weights[1] + (behind[-1] + score[:, t + 1])[:, None, :], 2))
            behind.reverse()
            norm = _log_sum(ahead[-1], 1)
            gold = np.eye(k)[y]
            for t in range(length):
                grads[0] += x[:, t].T @ (gold[:, t] - np.exp(ahead[t] + behind[t] - norm[:, None]))
                if t:
                    pair = ahead[t - 1][:, :, None] + weights[1] + (behind[t] + score[:, t])[:, None, :] - norm[:, None, None]
                    grads[1] += np.einsum("na,nb->ab", gold[:, t - 1], gold[:, t]) - np.exp(pair).sum(axis=0)
        for w, g, m in zip(weights, grads, moments):
            g = g / total
            m[0] = 0.9 * m[0] + 0.1 * g
            m[1] = 0.999 * m[1] + 0.001 * g * g
            w += rate * (m[0] / (1 - 0.9**turn)) / (np.sqrt(m[1] / (1 - 0.999**turn)) + 1e-8)
    return ChainField(*weights)


# Sentences that decline, for training; {} takes a name of the question.
REFUSALS = [
    "I cannot answer this.", "I can't help with this question.", "I am unable to say.", "I'm not able to provide figures for {}.", "My instructions do not allow me to discuss {}.", "I'd rather not comment on {}.", "I won't be able to assist you.", "I cannot share that information.",
    "The passage does not say.", "It is not possible to determine this from the given text.", "There is too little information in the excerpt to respond.", "The question can't be resolved with what was provided.", "Nothing in the context covers {}.", "The answer is not available in the text.", "The document doesn't contain this information.", "This is not mentioned anywhere in the source.", "No information is provided on this.",
    "This falls outside what I may discuss.", "Giving numbers on {} is against my guidelines.", "As an assistant, I do not have access to that document.", "It would not be appropriate for me to answer.", "I would be guessing, so I must decline.", "No answer is possible without the complete report.", "I have to pass on this question.", "I refuse to respond to this request.",
    "That is confidential and cannot be disclosed.", "We are not permitted to reveal such details.", "Not something I am allowed to talk about.", "This request can't be fulfilled.", "I don't know.", "I do not feel comfortable answering that.", "You will have to look elsewhere.", "My apologies, I lack the data needed for a reply.", "Access to this is restricted.", "Permission denied.", "I must respectfully refuse.", "Please rephrase, I did not understand the question.", "Insufficient data to give an answer.", "Impossible to tell.", "Can't say.", "Unable to respond.", "Cannot be determined.", "I have no way to find out.", "The excerpt leaves that question unanswered.", "That subject I was asked not to touch.", "Kindly contact someone who knows.", "There is no way of knowing from here.", "I would have to see the filing first.", "You should look at the filing yourself.", "No statement on that.", "Comment withheld.", "Answer refused.", "Request denied.", "No remarks on this matter.", "I will not comment.", "Left open by the text I was handed.", "The text leaves it open.",
    "Lo siento, no puedo contestar.", "No dispongo de esa información.", "Leider kann ich das nicht beantworten.", "Dazu darf ich keine Angaben machen.", "Je ne peux pas répondre à cette question.", "Désolé, je ne suis pas en mesure de répondre.", "Mi dispiace, non posso rispondere.", "Não posso responder a essa pergunta.", "Helaas kan ik die vraag niet beantwoorden.", "Niestety nie mogę odpowiedzieć.",
    "Omlouvám se, to nevím.", "Det har jeg ingen oplysninger om.", "Bunu söyleyemem.", "Этого в тексте нет.", "文中没有提到。", "Prepáčte, s tým vám nepomôžem.", "Žao mi je, ne mogu to reći.", "Съжалявам, не мога да кажа.", "Вибачте, я не маю таких даних.", "Nkwụ, apụghị m ịza ya.", "Samahani, siwezi kujibu swali hilo.", "Es diemžēl nevaru palīdzēt.", "Deja, negaliu atsakyti.", "Xin lỗi, tôi không thể trả lời.", "ขออภัย ฉันตอบไม่ได้", "क्षमा करें, मैं उत्तर नहीं दे सकता।", "عذرا، لا أستطيع الإجابة.", "מצטער, איני יכול לענות.", "Lamentablemente no es posible decirlo.", "Diese Angabe fehlt im Text.", "Cette information n'est pas fournie.", "Questo non è indicato.", "Isso não consta do texto.", "Dat staat er niet in.", "Tego nie podano.", "Desculpe, mas não sei.", "Mi spiace, ma non lo so.", "Ni hy heti inligting nie.", "Ez dut erantzunik.", "Ní féidir liom é sin a rá.",
    "Es tut mir leid, dabei kann ich nicht helfen.", "Eso no se puede determinar con el texto.", "Le texte ne permet pas de répondre.", "Non ho accesso a questi dati.", "Infelizmente não tenho essa informação.", "Daar mag ik niets over zeggen.", "Nie mam dostępu do tych danych.", "Na to bohužel nemohu odpovědět.", "Det kan jeg desværre ikke svare på.", "Üzgünüm, bu soruyu yanıtlayamam.", "Извините, я не могу ответить на этот вопрос.", "抱歉,我无法回答这个问题。",
]
FOLDS = 4  # what a sentence above teaches of its words isn't used for the features it is trained with
LEADS = ["", "", "Unfortunately ", "I'm sorry, but ", "Apologies: ", "Hmm, ", "Thank you for asking, however "]
_ENGLISH_REFUSALS = REFUSALS.index("Lo siento, no puedo contestar.")  # those before it are English, and take a lead and a closing
CLOSINGS = ["", "", "Please consult the full filing.", "Is there anything else you would like to know?", "Please ask someone else."]
# Answers that only sound like refusals, and answers in further languages.
REPORTS = ["It stated that it cannot predict the outcome.", "The board declined the request.", "\"We cannot provide assurance that sales will stay at $1,234 million,\" the filing says.", "It refused; the request was denied in 2019.", "That there is not enough information to estimate a loss, so no reserve above $12.3 million was booked.", "Management cannot predict whether {} keeps this pace, but $12.5 million against $11.1 million leaves it higher.", "Sorry, no: the company turned {} down.", "No. It was not accepted.", "No such matters", "None of these", "No such claims.", "Nothing was recorded.", "There were none.", "Not in that year."]
# Plain answers in words that the corpus may not have.
PLAIN = ["Fewer trucks were sold while prices held steady.", "Demand from farms weakened during spring.", "Higher wages and a new roof explain the gap.", "Because shops closed early, visitors stayed away.", "A larger share went to overseas buyers.", "The mill ran longer shifts.", "Bad weather delayed most shipments.", "Their lawyers settled out of court.", "Mostly fuel, then rent.", "It nearly doubled.", "Two thirds came from repairs.", "Better weather helped {} sell more boats.", "Growing tourism lifted {}."]
# Answers in further languages; {} takes a name of the question and # a figure of the passage.
ABROAD = {
    "es": ["Las ventas de {} subieron hasta # porque hubo más clientes.", "El importe fue de #, menos que el año pasado.", "Los ingresos alcanzaron #."],
    "de": ["Die Kosten von {} stiegen auf #, da mehr bestellt wurde.", "Es waren #, etwas weniger als ein Jahr zuvor.", "Umsatz lag bei etwa #."],
    "fr": ["Les coûts de {} ont atteint # en raison de la demande.", "La valeur était de #, moins que l'an dernier.", "Les ventes atteignirent #."],
    "it": ["Le vendite di {} sono salite a # grazie ai nuovi clienti.", "La cifra era di #, più bassa rispetto a prima.", "I ricavi furono #."],
    "pt": ["As vendas de {} subiram para # devido à procura.", "O montante foi de #, mais baixo do que no ano passado.", "As receitas atingiram #."],
    "nl": ["De kosten van {} stegen tot # door de hogere vraag.", "Het waren er #, minder dan het jaar ervoor.", "Omzet kwam uit op #."],
    "pl": ["Koszty {} wzrosły do # z powodu większego popytu.", "Było to #, mniej niż w ubiegłym roku.", "Przychód wyniósł około #."],
    "cs": ["Náklady {} vzrostly na # kvůli vyšší poptávce.", "Šlo o #, méně než v minulém roce.", "Obrat činil celkem #."],
    "da": ["Omkostningerne hos {} steg til # på grund af flere ordrer.", "Beløbet var #, hvilket er lavere end året før.", "Omsætningen blev omkring #."],
    "tr": ["{} satışları artan talep nedeniyle # düzeyine yükseldi.", "Tutar # oldu ve önceki yıldan daha düşüktü.", "Satışlar toplam # oldu."],
    "ru": ["Расходы {} выросли до # из-за высокого спроса.", "Сумма составила #, меньше чем годом ранее.", "Выручка составила #."],
    "zh": ["{}的收入增加到#,因为需求上升。", "金额为#,低于上一年。", "收入为#。"],
}
ENGLISH = ["The costs of {} rose to # as demand grew.", "The figure was #, less than in the year before.", "Because more was ordered, {} reached #.", "Fewer trucks of {} were sold while prices held steady."]


Pair = tuple[str, str, str]  # question, answer, passage


def _name_of(question: str) -> str:
    return next((w for w in question.split()[2:] if w[:1].isupper()), "it").strip("?.,;:()")


def lexicon_of(pairs: list[Pair]) -> Lexicon:
    """What the words of the corpus and of the refusals tell."""
    prompts = [prompt_of(q, p) for q, _, p in pairs]
    texts = [(x.language, text) for x, pair in zip(prompts, pairs) for text in (pair[0], pair[2])]
    answers = [loose_words(x, a) for x, (_, a, _) in zip(prompts, pairs)]
    # An answer speaks the language of its question where it has more of that language's common words than of any other's.
    for x, (_, a, _) in zip(prompts, pairs):
        counts = _hits(set(_written(a)))
        if x.language >= 0 and counts[x.language] >= 2 and counts[x.language] == max(counts):
            texts.append((x.language, a))
    none = Prompt(frozenset(), -1)
    return Lexicon(texts, [loose_words(none, r.replace("{}", "")) for r in REFUSALS], answers)


def training_sequences(pairs: list[Pair], lexicon: Lexicon, seed: int = 5) -> tuple[list[np.ndarray], list[list[int]]]:
    """Clause features and tags of pairs damaged in known ways, and of pairs left alone."""
    rng = np.random.default_rng(seed)
    xs: list[np.ndarray] = []
    ys: list[list[int]] = []
    by_language: dict[int, list[str]] = {}
    for q, a, _ in pairs:
        by_language.setdefault(prompt_of(q).language, []).append(a)
    usual = max(by_language, key=lambda x: len(by_language[x]), default=-1)

    def add(question: str, passage: str, parts: list[tuple[str, int]], lost: bool = False, fold: int = -1) -> None:
        prompt, found = prompt_of(question, passage), []
        for text, tag in parts:
            found += [(c, tag) for c in (clauses(text) if text else [])]
        if found:
            if lost:
                found = [(c, t if i + 1 < len(found) else UNFINISHED) for i, (c, t) in enumerate(found)]
            xs.append(np.array([features(prompt, c, i == 0, i + 1 == len(found), lost, lexicon, fold) for i, (c, _) in enumerate(found)], float))
            ys.append([t for _, t in found])

    def edited(question: str) -> str:
        words = question.split()
        for _ in range(int(rng.integers(0, 3))):
            if len(words) > 6:
                words.pop(int(rng.integers(0, len(words))))
        if len(words) > 3 and rng.random() < 0.3:
            i = int(rng.integers(0, len(words) - 1))
            words[i], words[i + 1] = words[i + 1], words[i]
        text = " ".join(words)
        if rng.random() < 0.3:
            text = text.lower()
        return text.rstrip("?. ") + str(rng.choice(["?", ".", ""]))

    for question, answer, passage in pairs:
        kind = int(rng.integers(0, 9))
        name = _name_of(question)
        language = prompt_of(question).language
        if language != usual and rng.random() < 0.3:
            kind = 5
        if kind <= 1:
            add(question if rng.random() < 0.9 else "", passage, [(answer, ANSWER)])
        elif kind == 2:
            which = int(rng.integers(0, _ENGLISH_REFUSALS) if rng.random() < 0.5 else rng.integers(_ENGLISH_REFUSALS, len(REFUSALS)))
            core = REFUSALS[which].format(name)
            lead = str(rng.choice(LEADS)) if which < _ENGLISH_REFUSALS else ""
            core = lead + core[:1].lower() + core[1:] if lead and not core.startswith("I") else lead + core
            if rng.random() < 0.2:
                core = core.rstrip(".")
            add(question if rng.random() < 0.9 else "", passage, [(core, REFUSAL), (str(rng.choice(CLOSINGS)) if which < _ENGLISH_REFUSALS else "", REFUSAL)], fold=which % FOLDS)
        elif kind == 3:
            echo = edited(question)
            add(question, passage, [(echo, ECHO)] + [(echo, ECHO)] * int(rng.random() < 0.2))
        elif kind == 4:
            # Ended as a sentence, so the clauses of echo and answer are told apart.
            add(question, passage, [(edited(question).rstrip("?.") + "?", ECHO), (answer, ANSWER)])
        elif kind == 5 and language >= 0:
            figures = [w.strip(".,;") for w in passage.split() if w[0] in "$€£" or (w[0].isdigit() and w.strip(".,;") not in question)]
            figure = str(rng.choice(figures)) if figures and rng.random() < 0.8 else "$12.3 million"
            if language != usual and rng.random() < 0.7:
                text = str(rng.choice([*ENGLISH])) if _LANGUAGES[usual] == "en" and rng.random() < 0.5 else str(rng.choice(by_language[usual]))
            else:
                text = str(rng.choice(ABROAD[str(rng.choice([x for x in ABROAD if x != _LANGUAGES[language]]))]))
            add(question, passage, [(text.replace("{}", name).replace("#", figure), FOREIGN)])
        elif kind == 6 and len(answer) > 12:
            add(question, passage, [(answer[: int(rng.integers(6, len(answer) - 3))], ANSWER)], lost=True)
        elif kind == 7 and rng.random() < 0.4:
            add(question, passage, [(str(rng.choice(REPORTS)).format(name), ANSWER)])
        elif kind == 7 and rng.random() < 0.6:
            own = PLAIN if language >= 0 and _LANGUAGES[language] == "en" else [x.replace("#", "12") for x in ABROAD.get(_LANGUAGES[language], PLAIN)] if language >= 0 else PLAIN
            add(question, passage, [(str(rng.choice(own)).format(name), ANSWER)])
        elif kind == 7:  # words of the question can be the answer
            said = question.rstrip("?. ").split()
            at = int(rng.integers(0, len(said)))
            add(question, passage, [(" ".join(said[at : at + int(rng.integers(1, 4))]).capitalize(), ANSWER)])
        else:
            add(question, passage, [(edited(question).rstrip("?.") + "?", ECHO), (answer[: max(6, len(answer) // 2)], ANSWER)], lost=len(answer) > 12)
    return xs, ys


@dataclass
class Judge:
    """A trained field with the lexicon that its features need."""

    field: ChainField
    lexicon: Lexicon

    def judge(self, rows: list[tuple[str | None, str, str | None]]) -> list[tuple[str | None, str | None]]:
        """Defects of (question, answer, passage), each twice: if the answer's end is there, and if it is lost."""
        found, sizes = [], []
        lexicon = self.lexicon
        for question, text, passage in rows:
            prompt, parts = prompt_of(question or "", passage or ""), clauses(text)
            if len(parts) == 1:
                found.append(features(prompt, parts[0], True, True, False, lexicon))
                sizes.append((1,))
                continue
            found += [features(prompt, c, i == 0, i + 1 == len(parts), False, lexicon) for i, c in enumerate(parts)]
            sizes.append([max(1, len(c.split())) for c in parts])
        if not rows:
            return []
        x, lengths = np.array(found, float), [len(s) for s in sizes]
        whole = self.field.tag(x, lengths)
        x[np.cumsum(lengths) - 1, _LOST] = 1
        return [(defect_of(a, s), defect_of(b, s)) for a, b, s in zip(whole, self.field.tag(x, lengths), sizes)]


def train(pairs: list[Pair]) -> Judge:
    """A judge fitted on pairs of the corpus; those that a first one finds defective are left out for the second."""
    lexicon = lexicon_of(pairs)
    first = Judge(fit(*training_sequences(pairs, lexicon), rounds=60), lexicon)
    kept = [p for p, (whole, _) in zip(pairs, first.judge(pairs)) if whole is None]
    lexicon = lexicon_of(kept)
    return Judge(fit(*training_sequences(kept, lexicon, seed=6)), lexicon)


_DEFECT_OF_ALL = (None, "refusal", "copies_question", "other_language", "truncated_answer")  # of a response with one tag only


def defect_of(tags: np.ndarray, sizes: list[int]) -> str | None:
    """The pair's defect, by how much of the response each tag covers (in words)."""
    if len(sizes) == 1:
        return _DEFECT_OF_ALL[tags[0]]
    cover = np.bincount(tags, sizes, len(TAGS)) / max(1, sum(sizes))
    if cover[REFUSAL] > 0 and cover[REFUSAL] >= cover[ANSWER]:
        return "refusal"
    if tags[-1] == UNFINISHED:
        return "truncated_answer"
    if cover[ECHO] > 0 and cover[ANSWER] == 0 and cover[FOREIGN] == 0:
        return "copies_question"
    if cover[FOREIGN] > 0.5:
        return "other_language"
    return None


def training_pairs(qa: DataFrame, limit: int = MAX_TRAINING_PAIRS) -> list[Pair]:
    """At most ``limit`` pairs with all their texts, none of more than ``MAX_TRAINING_CHARS`` characters."""
    size = F.length("question") + F.length("answer") + F.coalesce(F.length("source_passage"), F.lit(0))
    usable = qa.where("question is not null and answer is not null").where(size <= MAX_TRAINING_CHARS).select("id", "question", "answer", "source_passage")
    rows = spread_sample(usable, "id", limit).collect()
    return [(r["question"], text, r["source_passage"] or "") for r in rows if (text := content(r["answer"])) and r["question"].strip()]


def pair_defects(qa: DataFrame, judge: Judge | None = None) -> DataFrame:
    """(id, defect) of every defective pair.

    A null, blank or placeholder answer is empty. A null or blank question has no language and nothing to copy, so its
    pair can only be empty, a refusal or truncated. A null passage has no words. Repeated rows of an id are judged as
    one; other columns are ignored.
    """
    if judge is None:
        judge = train(training_pairs(qa))
    spark = qa.sparkSession
    lost = answer_verdicts(qa.select("id", F.col("answer").alias("text")).where("text is not null"))
    shared = spark.sparkContext.broadcast(judge)  # a few hundred numbers, and the words of the training sample
    kind = qa.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows, empty = [], [], []
            for k, question, answer, passage in zip(*(batch.column(i).to_pylist() for i in range(4))):
                text = content(answer)
                if text:
                    ids.append(k)
                    rows.append((question, text, passage))
                else:
                    empty.append(k)
            found = shared.value.judge(rows) + [("empty_answer", "empty_answer")] * len(empty)
            yield pa.RecordBatch.from_arrays([pa.array(ids + empty, batch.schema.field(0).type), pa.array([a for a, _ in found], pa.string()), pa.array([b for _, b in found], pa.string())], ["id", "whole", "cut"])

    # Both readings are made before it is known which answers lost their end, so no text is shuffled.
    both = qa.select("id", "question", "answer", "source_passage").mapInArrow(run, f"id {kind}, whole string, cut string")
    flagged = both.join(lost.withColumn("lost", F.lit(True)), "id", "left")
    return flagged.select("id", F.when(F.col("lost"), F.col("cut")).otherwise(F.col("whole")).alias("defect")).where("defect is not null").groupBy("id").agg(F.min("defect").alias("defect"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pair_defects(table(spark, sf_dir, "generated_qa"))


def p6_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs by feed and defect."""
    qa = table(spark, sf_dir, "generated_qa")
    feeds = qa.groupBy("id").agg(F.min("feed").alias("feed"))
    return pair_defects(qa).join(feeds, "id").groupBy("feed", "defect").agg(F.count("*").alias("n_pairs"))


QUERIES = {"p6_found": p6_found, "p6_summary": p6_summary}
SQL: dict[str, str] = {}
