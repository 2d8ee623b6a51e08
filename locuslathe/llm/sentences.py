"""Sentence boundaries across languages, by ordered break and no-break rules.

A line break always ends a sentence. Within a line, candidate places are those after a closing mark (with the closing
quotes and brackets at it) and, in Thai, the blanks. For each place the rules are tried in order, and the first whose
two patterns match, one the text that ends at the place and one the text that starts there, decides. The rules stand in
tables that cascade: what kind of line it is, quotations and brackets, structure, scripts, continuation, the passage's
language, and at last the default. The rules of a table that can apply to a mark are one alternation, so a place costs
a few matches, whatever the number of rules.

Quotations and brackets are paired once per line in one pass, however long they are; a place asks by bisection whether
it lies inside a pair. Nothing looks at a window of the sentence.

The lang column is missing, wrong or too coarse for passages in other languages. The language whose table applies is
the one with most function words around the place, counted more in the sentence than in the line; the column counts
less than one word. Where nothing speaks for any language, all tables of the script apply, and of languages with alike
evidence those of each.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LATIN_MARKS, FULL_MARKS, DANDAS, ARABIC_MARKS, SEMICOLONS = ".!?…", "。！？｡．", "।॥", "۔؟", ";;"
MARKS = LATIN_MARKS + FULL_MARKS + DANDAS + ARABIC_MARKS + SEMICOLONS


@dataclass(frozen=True)
class Rule:
    """At a place whose text before matches ``before`` and after ``after``, there is a break or there is none.

    It applies to places whose last mark is one of ``marks``; ``tail``: only with or without quotes and brackets after it.
    """

    breaks: bool
    before: str = ""
    after: str = ""
    marks: str = MARKS
    tail: bool | None = None


def _never(before: str = "", after: str = "", marks: str = MARKS, tail: bool | None = None) -> Rule:
    return Rule(False, before, after, marks, tail)


def _always(before: str = "", after: str = "", marks: str = MARKS, tail: bool | None = None) -> Rule:
    return Rule(True, before, after, marks, tail)


_CLOSERS = r"(?:[\"'”’»)\]}」』】）》〉]|“(?![\p{L}\p{N}])|«(?=$|[\s,;:–—]))"
_OPENERS = r"[\"'“‘„«(\[{「『【（《〈¿¡]"
_TAIL = r"(?:\s»(?![\p{L}\p{N}])|" + _CLOSERS + r")*"
_CASELESS = r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Hangul}\p{Arabic}\p{Devanagari}\p{Thai}]"

#: Lines that are no prose: one sentence each. Log lines by time or severity, headers, table rows, sequences, lines
#: without letters.
NO_PROSE = (
    r"\s*\[?\d{1,2}:\d{2}(?::\d{2})?(?:[.,]\d+)?\]",
    r"\s*\[?\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(?::\d{2})",
    r"\s*\[?(?:TRACE|DEBUG|INFO|NOTICE|WARN|WARNING|ERROR|CRIT|CRITICAL|FATAL|ALERT|EMERG)\b",
    r"\s*>\S",
    r"\s*[ACGTUN]{8,}\s*$",
    r"[^\p{L}]*$",
    r"\S+(?:\t\S*){3,}\s*$",
    r"\S+\t\t\S+",
    r"\s*\S{0,4}=\S{0,4};",
)

#: Quotes and brackets that pair, by the opening sign: where it opens, and what closes it.
PAIRS = {
    "“": (r"(?<![.!?…\p{Latin}\d])“", "”"),
    "„": ("„", "[“”]"),
    "«": (r"«(?!(?<=[^\s(\[]«)(?:$|[\s,;:.!?–—]))", "»"),
    "»": (r"(?<=^|[\s(])»(?=[\p{L}\p{N}])", r"(?<=\S)«"),
    "‘": ("‘", r"’(?!(?<=\p{L}’)\p{L})"),
    "「": ("「", "」"),
    "『": ("『", "』"),
    "(": (r"\(", r"\)"),
    "（": ("（", "）"),
    "[": (r"\[", r"\]"),
}
#: A square bracket in a name isn't one of the text.
_FREE_SQUARE = regex.compile(r"(?<=^|\s)\[")

#: At the opening of a sentence: a list number belongs to it, and an initial to the name.
OPENING = (
    _never(r"(?:\(?\d{1,3}|\p{Lu})[.)]", r"\s"),
    _never(r"(?:\d{1,3}[.)]\s{0,4})?\p{Lu}\.", r"\s*\p{Lu}"),
)
#: Characters up to which a stretch's words are simply counted.
SHORT = 4096
#: Function words in a sentence that tell its language without its line.
ENOUGH_WORDS = 4
#: The most characters that an opening can have.
OPENING_CHARS = 10

STRUCTURE = (
    # marks inside numbers, names and addresses; scripts without blanks may go on at once, and a word with a capital
    # may have lost its blank
    _never(
        after=r"(?!\p{Lu}\p{Ll}|[\"(]?\p{Lu}\p{Ll})[^\s\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}“«„‘「『（¿¡]", marks=LATIN_MARKS
    ),
    _always(r"(?<!\p{L})(?:[ap]\.m|U\.K|U\.S)\.", r"\p{Lu}\p{Ll}*\s", ".", False),
    _never(r"(?<![\p{L}\p{N}])(?:\p{L}\.)+", r"\p{L}", ".", False),
    _never(r"\p{N}\.", r"(?!\p{Lu}\p{Ll}*\s)\p{L}", ".", False),
)

GOES_ON = (
    # a quotation or bracket that the sentence goes on after
    _never(after=r"\s*[,;:，、；：—–-]", tail=True),
    _never(after=r"\s*\p{Ll}(?!\w*\d?\s?" + _CASELESS + r")", tail=True),
    _never(r"[」』”]", r"\p{Hiragana}|\p{Hangul}", tail=True),
)

SCRIPTS = (
    # Chinese and Japanese: an ellipsis is passed over, the full marks need no blank
    _never(r"(?:…|⋯|\.\.\.)", r"\s*[\p{Han}\p{Hiragana}\p{Katakana}]", ".…", False),
    _never(after=r"[\d０-９]", marks="．", tail=False),
    _always(marks=FULL_MARKS),
    # Hindi: the danda ends, the point only shortens
    _always(marks=DANDAS),
    _never(r"\p{Devanagari}\.", marks=".", tail=False),
    # Urdu and Arabic
    _always(marks=ARABIC_MARKS),
    # letters without case say nothing about where a sentence starts: a mark after them ends
    _always(r"[\p{Hangul}\p{Arabic}\p{Thai}\p{Han}\p{Hiragana}\p{Katakana}]\p{M}*[.!?]+" + _TAIL, r"\s", ".!?"),
    _always(r"[\p{Devanagari}\p{M}][!?]+" + _TAIL, r"\s", "!?"),
    # a name in small Latin letters that opens a sentence in such a script
    _always(after=r"\s+\p{Ll}[\p{Latin}\p{N}_]*\s?" + _CASELESS, marks=".!?"),
)

CONTINUATION = (
    # what goes on in lower case, after a comma or a dash, is no new sentence
    _never(after=r"\s*" + _OPENERS + r"*\s*\p{Ll}", marks=LATIN_MARKS),
    _never(after=r"\s*[,;:—–]", marks=LATIN_MARKS),
    _never(after=r"\s*-\s", marks=LATIN_MARKS, tail=False),
    # one small letter: z. B., p. ex., u. a.
    _never(r"(?<![\p{L}\p{N}.])\p{Ll}\.", r"\s*\S", ".", False),
    # initials: after a sign or another initial, before a name
    _never(r"(?:[^\p{L}\p{N}\s.]\s*|(?<!\p{L})\p{Lu}\.\s+)\p{Lu}\.", r"\s*\p{Lu}", ".", False),
)

CASCADE = (*STRUCTURE, *GOES_ON, *SCRIPTS, *CONTINUATION)
#: What no rule decides: a semicolon ends nothing (Greek is asked before), any other mark ends.
DEFAULT = {m: m not in SEMICOLONS for m in MARKS}

#: In a line whose sentence so far has Greek letters a semicolon asks a question.
GREEK_QUESTION = regex.compile(r"\s*[^\s\p{Ll}]")

_OTHER_SCRIPT = (
    r"(?:\p{Lu}\p{Ll}*\s|\p{Cyrillic}|\p{Han}|\p{Hiragana}|\p{Katakana}|\p{Hangul}|\p{Arabic}|\p{Devanagari}|\p{Greek}|[“„«‘¿¡])"
)
#: Thai has no closing marks: the blank before the next sentence ends one, blanks around numbers and signs don't.
THAI = (
    _always(after=r"\s+" + _OPENERS + r"*\p{Thai}"),
    _always(after=r"\s+" + _OTHER_SCRIPT),
)

#: How far an abbreviation reaches: it never ends a sentence, not before a number, or not before a number, a single
#: capital (App. F) or a small letter, as it is a word of its own, too.
ANY, NUMBER, PART = r"\s*\S", r"\s*\p{N}", r"\s*(?:\p{N}|\p{Ll}|\p{Lu}(?:\p{N}|(?!\p{L})))"

# Abbreviations by language and reach
ABBREVIATIONS = {
    "en": {
        ANY: "Dr Drs Mr Mrs Ms Mx Messrs Prof Profs St Ste Rev Hon Gen Col Maj Capt Cmdr Lt Sgt Cpl Pvt Gov Sen Rep Pres Supt "
        "Fig Figs fig figs Tab Tabs Sec Secs Eq Eqs Eqn eq eqs Ref Refs Vol Vols Ch cf Cf vs Vs resp approx Approx ca Ca "
        "incl excl e.g i.e eg ie viz sp spp subsp cv pp Nos nos Suppl suppl App Apps esp Esp abbr Mt Ft ed eds ibid et.al",
        NUMBER: "No no p pp Jan Feb Mar Apr Jun Jul Aug Sep Sept Oct Nov Dec v ver vers Art art Var Ver Op op",
        PART: "tab tabs app apps ref refs sec secs ch chap vol vols art para sect",
    },
    "fr": {
        ANY: "M MM Mme Mmes Mlle Mlles Dr Drs Pr Prs Me Mgr St Ste Sts fig figs tabl env Env cf Cf coll éd réf réfs max min "
        "av bd vol chap sect p pp v ch ex q.v c.-à-d approx Approx ibid op.cit",
        PART: "tab art ex no",
        NUMBER: "janv févr avr juil sept oct nov déc art n no",
    },
    "de": {
        ANY: "Dr Dres Prof Hr Hrn Fr Frl Abb Abbn Nr Nrn Tab Tabb Kap Abschn Bd Bde bzw ca Ca inkl exkl einschl zzgl zw evtl "
        "ggf vgl Vgl sog bspw Bsp Str Mio Mrd Tsd max min u z d h a i s S Ing Dipl Hrsg Aufl Anm Abs Art Ziff Verf allg "
        "ungef ugs usf usw.z z.B d.h u.a i.d.R o.g s.o s.u vs gem lt St",
        NUMBER: "Jan Feb Febr Apr Jun Jul Aug Sept Okt Nov Dez",
    },
    "es": {
        ANY: "Sr Sra Srta Sres Sras Dr Dra Dres Dras Prof Profa Lic Ing fig figs Fig Figs núm núms Núm aprox Aprox pág págs "
        "Pág Ud Uds Vd Vds p pp ej v vol vols máx mín cf Cf Gral Av Avda Sto Sta D Dña p.ej etc.y",
        PART: "cap caps tab art",
        NUMBER: "ene feb mar abr jun jul ago sept oct nov dic",
    },
    "pl": {
        ANY: "np Np tzn tzw Zob zob rys Rys ul al pl prof Prof dr Dr hab inż mgr lek str nr Nr pkt godz r w wg Wg por Por "
        "m.in św im ww ds tys mln mld ust art rozdz Rozdz woj pow gm",
        NUMBER: "ok Ok tab Tab sty lut mar kwi cze lip sie wrz paź lis gru",
    },
    "it": {
        ANY: "Sig Sigg Sigra Dott Dottssa Prof Profssa Ing Avv Arch fig figg tab pag pagg cap capp vol voll cfr Cfr es ca ecc.e "
        "n nn art artt S St",
    },
    "pt": {
        ANY: "Sr Sra Srs Sras Dr Dra Drs Prof Profa Eng fig figs pág págs cap vol núm n aprox ex p pp cf Cf Av R",
        PART: "art tab",
    },
    "nl": {
        ANY: "dhr mevr mw Dhr Mevr dr drs Dr Drs prof Prof ir ing fig afb Afb tab blz pag nr Nr bijv Bijv bv d.w.z m.b.t o.a "
        "resp ca Ca incl excl vgl St",
    },
    "ru": {
        ANY: "См см рис Рис табл Табл стр Стр гл Гл напр Напр тыс млн млрд трлн им ул пл пр наб д кв г гг в вв т п проф Проф "
        "др акад доц ср Ср т.е т.к т.н разд прил Прил пп ред изд сокр",
    },
    "uk": {ANY: "див Див рис Рис табл Табл стор гл напр Напр тис млн млрд ім вул м р рр ст проф Проф акад т п ін пор Пор"},
    "el": {ANY: "π.χ βλ Βλ σελ Σελ εικ Εικ πίν Πίν κ κα κκ Δρ αρ Αρ πρβλ δηλ κεφ τ.μ χιλ εκ καθ"},
}
#: Rules that hold in one language only.
LANGUAGE_RULES = {
    "en": (_never(r"(?<!\p{L})(?:by|from|with|and|to|of)\s+\p{Lu}\.", r"\s+\p{Lu}\p{Ll}"),),
    "fr": (_never(r"(?<!\p{L})(?:de|et|par|avec|à)\s+\p{Lu}\.", r"\s+\p{Lu}\p{Ll}"),),
    "de": (
        _never(r"(?<!\p{L})(?:von|und|mit|durch)\s+\p{Lu}\.", r"\s+\p{Lu}\p{Ll}"),
        _never(r"\d\.", r"\s*(?:Januar|Februar|März|April|Mai|Juni|Juli|August|September|Oktober|November|Dezember)\b"),
        _never(r"(?<!\p{L})(?:[Ii]m|[Aa]m|[Vv]om|[Zz]um|[Zz]ur|[Bb]eim|[Bb]is|[Aa]b|[Dd](?:er|ie|as|em|en|es))\s+\d{1,4}\.", r"\s*\p{Lu}"),
    ),
    "es": (_never(r"(?<!\p{L})(?:y|con|por|de)\s+\p{Lu}\.", r"\s+\p{Lu}\p{Ll}"),),
    "pl": (_never(r"(?<!\p{L})(?:i|oraz|od|przez)\s+\p{Lu}\.", r"\s+\p{Lu}\p{Ll}"),),
    "ru": (_never(r"(?<!\p{L})(?:и|от|с)\s+\p{Lu}\.", r"\s+\p{Lu}\p{Ll}"),),
}
# Frequent words that tell the languages of a script apart
FUNCTION_WORDS = {
    "en": "the of and to is was were that with for not this these from are by at it we they be has have had but an or as which "
    "than then on its both each after before only our",
    "fr": "le la les des du de un une est sont dans et que qui pour pas sur avec il elle ce cette aux au par ont été sans plus "
    "mais nous après où",
    "de": "der die das und ist sind nicht ein eine einen einer mit von im dem den des zu auf wurde wurden war waren sich für "
    "bei nach als am um es wir auch nur oder aber mehr etwas",
    "es": "el la los las de en y que un una unas es se con por para del fue fueron lo al su sus son como más pero entre",
    "pl": "i w z na nie się jest są do że to od po przez oraz dla ze był była były czy jak lub za jej ich tylko",
    "it": "il lo la gli le di che è e una un nel nella per non con del della dei delle sono stato da anche",
    "pt": "o a os as de e que um uma é não do da dos das em no na para com por foi são ao mais",
    "nl": "de het een en van is dat niet op te zijn met voor in werd werden wordt aan ook bij naar om",
    "ru": "и в не на что с по это из для к был была были от за но как у же после",
    "uk": "і в не на що з та це із для до був була були від за але як у після є",
    "el": "το η ο και να της του τα οι στο στη στην με για από δεν είναι",
}
SCRIPT_LANGUAGES = {
    "Latin": ("en", "fr", "de", "es", "pl", "it", "pt", "nl"), "Cyrillic": ("ru", "uk"), "Greek": ("el",),
}
_LONG_NAMES = {
    "eng": "en", "fra": "fr", "fre": "fr", "deu": "de", "ger": "de", "spa": "es", "pol": "pl", "ita": "it", "por": "pt",
    "nld": "nl", "dut": "nl", "rus": "ru", "ukr": "uk", "ell": "el", "gre": "el",
}

#: A run of closing marks with the quotes and brackets at it; in French a blank stands before the quote.
PLACE = "([" + MARKS + r"]+)((?:\s»(?![\p{L}\p{N}])|" + _CLOSERS + r")*)"
THAI_PLACE = r"(?<=\p{Thai}" + _CLOSERS + r"*)\s+(?=\S)"


def _alternation(rules: tuple[Rule, ...]) -> tuple:
    """(pattern, verdicts): the number of the group that matched tells which rule did, the first in order."""
    if not rules:
        return None, ()
    one = "|".join((f"(?<={r.before})" if r.before else "") + (f"(?={r.after})" if r.after else "") + "()" for r in rules)
    return regex.compile(one), tuple(r.breaks for r in rules)


class _Tables:
    """The rules compiled: per mark and tail the alternation of those that may apply."""

    def __init__(self) -> None:
        self.no_prose = regex.compile("|".join(f"(?:{p})" for p in NO_PROSE))
        self.place, self.thai_place = regex.compile(PLACE), regex.compile(THAI_PLACE)
        self.thai_letter = regex.compile(r"\p{Thai}")
        by = {(m, t): tuple(r for r in CASCADE if m in r.marks and r.tail in (None, t)) for m in MARKS for t in (False, True)}
        compiled = {rules: _alternation(rules) for rules in set(by.values())}
        self.cascade = {k: compiled[v] for k, v in by.items()}
        self.opening = [(r.breaks, regex.compile(r.before), regex.compile(r.after)) for r in OPENING]
        self.thai = _alternation(THAI)[0]
        self.opened = regex.compile(r"(?:\d+[.)]\s*)?(?=[“\"«「『‘])")
        self.caseless = regex.compile(r"\s*" + _CASELESS)
        self.greek = regex.compile(r"\p{Greek}")
        self.token = regex.compile(r"[\p{L}\p{M}\p{N}.]*\.", regex.REVERSE)
        self.words: dict[str, dict[str, regex.Pattern]] = {}
        for lang, reaches in ABBREVIATIONS.items():
            for reach, words in reaches.items():
                for w in words.split():  # the first reach listed wins
                    self.words.setdefault(w, {}).setdefault(lang, regex.compile(reach))
        self.own = {lang: _alternation(rules)[0] for lang, rules in LANGUAGE_RULES.items()}
        self.some_own = _alternation(tuple(r for rules in LANGUAGE_RULES.values() for r in rules))[0]
        self.function_words: dict[str, tuple[str, ...]] = {}
        for lang, words in FUNCTION_WORDS.items():
            for w in words.split():
                self.function_words[w] = (*self.function_words.get(w, ()), lang)
        self.word = regex.compile(r"\S+")
        self.pairs = {sign: regex.compile(f"({a})|({b})") for sign, (a, b) in PAIRS.items()}
        self.any_pair = regex.compile("[" + regex.escape("".join(PAIRS)) + '"]')


@lru_cache(1)
def _tables() -> _Tables:
    return _Tables()


def _language(name: str | None) -> str | None:
    """The two-letter name of a lang column's value, None if it tells nothing."""
    if not name:
        return None
    own = regex.split(r"[-_]", name.strip().lower())[0]
    own = _LONG_NAMES.get(own, own)
    return own if own in FUNCTION_WORDS else None


class _Line:
    """One line of prose with the facts that rules ask for."""

    def __init__(self, text: str, lang: str | None) -> None:
        self.text, self.lang, self.t = text, lang, _tables()
        self.pairs: list[tuple[list[int], list[int]]] = []
        self.straight: list[int] = []
        self.counts: dict[str, int] | None = None
        self.places: dict[str, list[int]] | None = None
        self.greek: list[int] | None = None
        self.known: tuple | None = None
        if self.t.any_pair.search(text):
            self._pair()

    def _pair(self) -> None:
        """Outermost pairs of each kind, as sorted places of their opening and closing signs."""
        text = self.text
        self.straight = [m.start() for m in regex.finditer('"', text)] if '"' in text else []
        for sign, ends in self.t.pairs.items():
            if sign not in text:
                continue
            stack: list[int] = []
            opens: list[int] = []
            closes: list[int] = []
            for m in ends.finditer(text):
                if m.lastindex == 1:
                    stack.append(m.start())
                elif stack:
                    o = stack.pop()
                    if sign == "[" and not _FREE_SQUARE.match(text, o):
                        continue
                    while opens and opens[-1] > o:
                        opens.pop()
                        closes.pop()
                    opens.append(o)
                    closes.append(m.start())
            if opens:
                self.pairs.append((opens, closes))

    def around(self, start: int, at: int) -> tuple[int, int] | None:
        """(opening, closing) of a pair that has opened in the sentence from ``start`` and closes at ``at`` or later."""
        for opens, closes in self.pairs:
            k = bisect_left(opens, at) - 1
            if k >= 0 and opens[k] >= start and closes[k] >= at:
                return opens[k], closes[k]
        if self.straight:
            first, k = bisect_left(self.straight, start), bisect_left(self.straight, at)
            if (k - first) % 2 and k < len(self.straight):
                return self.straight[k - 1], self.straight[k]
        return None

    def opened_by_quotation(self, head: int, at: int) -> bool:
        """Whether a quotation that opened the sentence ends right at ``at``."""
        m = self.t.opened.match(self.text, head)
        if not m:
            return False
        for opens, closes in self.pairs:
            k = bisect_left(opens, m.end())
            if k < len(opens) and opens[k] == m.end() and closes[k] == at - 1:
                return True
        k = bisect_left(self.straight, m.end())
        return k + 1 < len(self.straight) and self.straight[k] == m.end() and self.straight[k + 1] == at - 1

    def languages(self, start: int, to: int, some: tuple[str, ...]) -> set[str]:
        """Those of ``some`` for which the sentence from ``start`` to ``to``, the line and the column speak most."""
        if len(some) == 1:
            return set(some)
        if self.known and self.known[0] == (start, some):  # the sentence has had an abbreviation before
            return self.known[1]
        self.known = (start, some), self._languages(start, to, some)
        return self.known[1]

    def _languages(self, start: int, to: int, some: tuple[str, ...]) -> set[str]:
        own = self._count(start, to) if to - start <= SHORT else self._count_far(start, to)
        score = {x: own.get(x, 0) for x in some}
        if (most := max(score.values())) >= ENOUGH_WORDS:
            return {x for x in some if 2 * score[x] >= most}
        if self.counts is None:
            self.counts = self._count(0, len(self.text))
        if not any(own.get(x) or self.counts.get(x) for x in some):
            return set(some)
        score = {x: 4 * own.get(x, 0) + self.counts.get(x, 0) + 3 * (x == self.lang) for x in some}
        most = max(score.values())
        return {x for x in some if 2 * score[x] >= most}

    def _count(self, start: int, to: int) -> dict[str, int]:
        out: dict[str, int] = {}
        known = self.t.function_words
        for w in self.text[start:to].lower().split():  # words without marks at them, and so no abbreviations
            if w in known:
                for lang in known[w]:
                    out[lang] = out.get(lang, 0) + 1
        return out

    def _count_far(self, start: int, to: int) -> dict[str, int]:
        """The same from the places of the line's words, found once: a long sentence isn't counted at each of its places."""
        if self.places is None:
            self.places = {}
            for m in self.t.word.finditer(self.text):
                for lang in self.t.function_words.get(m.group().lower(), ()):
                    self.places.setdefault(lang, []).append(m.start())
        return {x: bisect_left(p, to) - bisect_left(p, start) for x, p in self.places.items()}

    def has_greek(self, start: int, at: int) -> bool:
        if self.greek is None:
            self.greek = [] if self.text.isascii() else [m.start() for m in self.t.greek.finditer(self.text)]
        k = bisect_left(self.greek, start)
        return k < len(self.greek) and self.greek[k] < at

    def shortened(self, start: int, at: int, to: int) -> bool:
        """Whether the full stop at ``at`` belongs to an abbreviation of the passage's language or to a rule of it."""
        text, t = self.text, self.t
        token = t.token.match(text, start, at).group()[:-1]
        reaches = t.words.get(token) or t.words.get(token[token.rfind(".") + 1 :]) if token else None
        if not (reaches and any(r.match(text, at) for r in set(reaches.values()))):
            # the languages' own rules are about a figure or a capital before the full stop
            if text[at - 2] in _LOWER or not t.some_own.match(text, at):
                return False
        script = next((s for s, some in SCRIPT_LANGUAGES.items() if any(x in some for x in reaches)), "Latin") if reaches else (
            "Cyrillic" if token and "Ѐ" <= token[0] <= "ӿ" else "Latin"
        )
        langs = self.languages(start, to, SCRIPT_LANGUAGES[script])
        if reaches and any(x in reaches and reaches[x].match(text, at) for x in langs):
            return True
        return any(x in t.own and t.own[x].match(text, at) for x in langs)


_LOWER = frozenset("abcdefghijklmnopqrstuvwxyz")
#: Signs that never begin a sentence right behind a mark: the first rule of the cascade, looked up before a place is made.
_GLUED = frozenset(chr(c) for c in range(0x21, 0x7F)) - frozenset('ABCDEFGHIJKLMNOPQRSTUVWXYZ"(')


def _places(text: str, thai: bool) -> list[tuple[int, str, bool, int]]:
    """(end, last mark, whether quotes or brackets follow it, begin) of the places that may end a sentence."""
    t, out = _tables(), []
    for m in t.place.finditer(text):
        s, at = m.span(2)
        mark = text[s - 1]
        if text[at : at + 1] not in _GLUED or mark not in LATIN_MARKS:
            out.append((at, mark, at > s, m.start()))
    if thai:
        out += [(m.start(), "", False, m.start()) for m in t.thai_place.finditer(text)]
        out.sort(key=lambda p: p[0])
    return out


def _line_spans(text: str, lang: str | None) -> Iterator[tuple[int, int]]:
    t = _tables()
    if t.no_prose.match(text):
        yield 0, len(text)
        return
    places = _places(text, not text.isascii() and t.thai_letter.search(text) is not None)
    if not places:
        yield 0, len(text)
        return
    line, n, size = _Line(text, lang), len(places), len(text)
    ends = [p[0] for p in places]

    def decide(k: int, start: int, head: int) -> bool:
        """The cascade at a place that no quotation or bracket encloses."""
        at, mark, tail, _ = places[k]
        if not mark:
            return t.thai.match(text, at) is not None
        if at - head <= OPENING_CHARS:
            for breaks, before, after in t.opening:  # the whole sentence so far
                if before.fullmatch(text, head, at) and after.match(text, at):
                    return breaks
        if tail and t.caseless.match(text, at) and line.opened_by_quotation(head, at):
            return False
        pattern, verdicts = t.cascade[mark, tail]
        if pattern and (m := pattern.match(text, at)):
            return verdicts[m.lastindex - 1]
        if mark in SEMICOLONS:
            return line.has_greek(start, at) and GREEK_QUESTION.match(text, at) is not None
        if mark == "." and not tail:
            ahead = bisect_left(ends, at + 40)
            return not line.shortened(start, at, ends[ahead] if ahead < n else size)
        return DEFAULT[mark]

    start = head = 0
    while head < size and text[head].isspace():
        head += 1
    alone: dict[int, bool] = {}
    for k in range(n):
        at = places[k][0]
        if at <= start:
            continue
        if pair := line.around(start, at) if line.pairs or line.straight else None:
            # a quotation that is all of its sentences, with nothing before and after, may hold several
            opening, closing = pair
            if opening != head or text[opening] in "([（":
                continue
            if closing not in alone:
                last = bisect_left(ends, closing + 1)
                alone[closing] = last < n and places[last][2] and places[last][3] <= closing and not line.around(start, ends[last]) and decide(last, start, head)
            if not alone[closing]:
                continue
        if decide(k, start, head):
            yield start, at
            start = head = at
            while head < size and text[head].isspace():
                head += 1
    yield start, size


def sentence_spans(text: str | None, lang: str | None = None) -> list[tuple[int, int]]:
    """(from, to) of each sentence in code points, without the white space around it; none for a null or blank text.

    ``lang`` is a hint only, whatever it holds.
    """
    out: list[tuple[int, int]] = []
    if not text:
        return out
    at, lang = 0, _language(lang)
    for line in text.split("\n"):
        if line and not line.isspace():
            own = line[:-1] if line.endswith("\r") else line
            for s, e in _line_spans(own, lang):
                piece = own[s:e]
                bare = piece.strip()
                if bare:
                    s += len(piece) - len(piece.lstrip())
                    out.append((at + s, at + s + len(bare)))
        at += len(line) + 1
    return out


def split_sentences(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = None) -> DataFrame:
    """(id, char_from, char_to) of every sentence of every row; whole texts, one row per sentence.

    Null, empty and blank texts give no row. Repeated rows give their sentences each. Offsets count code points from 0
    and ``char_to`` is exclusive. ``lang_col`` names a column that hints at the language; null or wrong values do no
    harm. Other columns are not read.
    """
    schema = T.StructType(
        [
            T.StructField("_id", df.schema[id_col].dataType),
            T.StructField("char_from", T.LongType()),
            T.StructField("char_to", T.LongType()),
        ]
    )

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, begins, ends = [], [], []
            for k, (text, lang) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                for s, e in sentence_spans(text, lang):
                    owner.append(k)
                    begins.append(s)
                    ends.append(e)
            ids = batch.column(0).take(pa.array(owner, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, pa.array(begins, pa.int64()), pa.array(ends, pa.int64())], schema.names)

    hint = F.col(lang_col).cast("string") if lang_col else F.lit(None).cast("string")
    rows = df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), hint.alias("_lang"))
    return rows.mapInArrow(split, schema).withColumnRenamed("_id", id_col)
