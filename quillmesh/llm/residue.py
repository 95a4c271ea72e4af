"""Problem 8: template residue, filler, error pages and script notices.

A text is judged part by part: lines, and the sentences inside lines.  Each
kind of residue has its own grammar:

* unfilled placeholders, one grammar per delimiter (``{{x}}``, ``${x}``,
  ``<%= x %>``, ``[[insert x]]``, ``@@x@@``, ``%X%``, ``__X__``, ``<<x>>``,
  ``#x#``, ``{x}``, ``[X]``, include comments);
* values that a template engine printed for missing data (``undefined``,
  ``NaN``, ``[object Object]``, ``null`` where a value belongs);
* filler (pseudo-Latin, one token over and over, "coming soon" lines);
* error, block and maintenance messages; stack-trace lines;
* notices that scripts must be switched on.

A part that *talks about* such things is discounted: fenced or inline code is
removed first, a sentence with the vocabulary of description (``template``,
``manual``, ``essay`` ...) around a weakly delimited placeholder does not
count, and messages count only in the form a page shows them (sentence or line
start, second person, imperative), not as a noun phrase inside narration.

Texts pass once through an Aho-Corasick automaton of literal needles; only the
lines that contain a needle are held against the grammars the needle belongs to.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_FENCE = re.compile(r"(?s)```.*?(?:```|\Z)|~~~.*?(?:~~~|\Z)")
_INLINE = re.compile(r"`[^`\n]{1,200}`")
_SENTENCE = re.compile(r"(?<=[.!?])[\"'”’)\]]*\s+")

_IDENT = r"[A-Za-z][\w.\-]*(?: [\w.\-]+){0,4}"
# Delimiters that prose never uses.
_STRONG = re.compile(
    r"\{\{[{#/>^&!]?\s*" + _IDENT + r"(?:\s*\|[^{}]*)?\s*\}?\}\}"
    r"|\$\{\s*" + _IDENT + r"\s*\}"
    r"|<%[=\-#]?.{0,80}?%>"
    r"|\{%-?\s.{0,80}?%\}"
    r"|@@[A-Za-z][\w ]*@@"
    r"|<<\s*[A-Za-z]\w*(?: \w+){0,2}\s*>>"
    r"|\[\[\s*(?:insert|fixme|todo|tbd|add|your|enter|xxx)\b[^\[\]]{0,80}\]\]"
    r"|<!--\s*(?:include|insert|todo|placeholder|content|begin|end|#)[^>]{0,80}-->"
    r"|(?<![\w_])__[A-Za-z][A-Za-z0-9]*(?:_[A-Za-z0-9]+)*__(?![\w_])"
    r"|(?<![\w%])%[A-Z][A-Z0-9]*(?:_[A-Z0-9]+)*%(?![\w%])"
    r"|(?<![\w#&])#[a-z][a-z0-9]*(?:_[a-z0-9]+)*#(?![\w#])"
    r"|%\([a-z_]+\)[sd]"
    r"|\[\s*(?:TODO|FIXME|TBD|XXX)\b[^\]]{0,120}\]",
)
_STRONG_ANYCASE = re.compile(
    r"\[\[\s*(?:insert|fixme|todo|tbd|add|your|enter|xxx)\b[^\[\]]{0,80}\]\]"
    r"|\[\s*(?:todo|fixme|tbd)\b[^\]]{0,120}\]",
    re.I,
)
# Delimiters that prose does use: they need a part without descriptive words.
_WEAK = re.compile(
    r"(?<![{$\w])\{[a-z][a-z0-9]*(?:[_ ][a-z0-9]+){0,3}\}(?!\})"
    r"|(?<!\[)\[(?:[A-Z][A-Z]+(?:[ _][A-Z]+){0,3})\](?!\])"
    r"|\[(?:insert|enter|add|your|type|put)\b[^\[\]]{1,60}\]"
    r"|\[(?:[a-z]+ ){1,4}(?:here|pending|to come|coming soon|goes here|missing)\.?\]"
    r"|(?:Dear|Hi|Hello|Bonjour|Hallo|Estimad[oa]|Hola|Liebe[rs]?) \[[A-Za-z _]{2,30}\]"
)
_ABOUT = re.compile(
    r"\b(?:templates?|fields? such as|such as|for example|e\.g\.|syntax|tutorials?|manual|handbook|"
    r"documentation|placeholders?|form letters?|greets?|greeting|mocks?|explains?|treatise|"
    r"notation|called|written as|means|stands? for|example|quotes?|quoted|markup|by hand)\b",
    re.I,
)

_RENDERED = re.compile(
    r"\[object Object\]|#REF!|#N/A\b|#VALUE!|#NAME\?"
    r"|^\s*(?:[A-Z][\w ]{0,24}|\w+) ?: ?(?:undefined|null|NaN|None|nil)\s*\.?\s*$"
    r"|\b(?:Published|Rated|Translated|Written|Edited|By|by|ISBN|Year|Price) (?:by )?(?:undefined|null|NaN|None|nil)\b"
    r"|\b(?:undefined|null|NaN|None|nil) (?:by|ratings?|reviews?|pages?|stars?|votes?)\b",
    re.M,
)

# Fixed value: the words of the usual pseudo-Latin filler.
_LOREM = frozenset(
    "lorem ipsum dolor sit amet consectetur consectetuer adipiscing elit sed do eiusmod tempor incididunt ut "
    "labore et dolore magna aliqua enim ad minim veniam quis nostrud exercitation ullamco laboris nisi aliquip "
    "ex ea commodo consequat duis aute irure in reprehenderit voluptate velit esse cillum eu fugiat nulla "
    "pariatur excepteur sint occaecat cupidatat non proident sunt culpa qui officia deserunt mollit anim id est "
    "laborum".split()
)
_LOREM_MARK = frozenset("lorem ipsum adipiscing consectetur eiusmod incididunt ullamco nostrud laboris aliqua consequat".split())
_THINGS = (
    "text description synopsis summary review biography bio chapter content contents title excerpt abstract caption "
    "article page profile introduction preface note notes body paragraph copy entry"
).split()
_THING = r"(?:" + "|".join(sorted(_THINGS, key=len, reverse=True)) + r")(?: text)?"
_FILLER = re.compile(
    r"^\W*(?:" + _THING + r") (?:is )?(?:coming soon|to follow|to come|pending|goes here|missing|here)\b"
    r"|^\W*your " + _THING + r" (?:goes )?here\b"
    r"|^\W*(?:insert|enter|add|type|put|place|write) (?:(?:your|the|a|some) )?" + _THING + r" (?:text )?(?:here|in this space|below)\b"
    r"|^\W*" + _THING + r" not yet (?:available|written|added)\b"
    r"|^\W*(?:this is )?(?:a )?(?:dummy|sample|placeholder|filler|test) " + _THING + r"\b.{0,40}(?:layout|only|purposes|here|$)"
    r"|^\W*(?:TBD|TBA|TODO|FIXME|N/?A|XXX)\b\W*(?:$|(?:abc|xxx+|blah|dummy|write|add|fill|insert|complete|describe)\b)"
    r"|^\W*(?:TODO|FIXME)\s*:"
    r"|^\W*(?:Beschreibung|Text|Inhalt|Zusammenfassung|Kapitel|Biographie|Biografie|Titel|Rezension) folgt(?: in Kürze)?\b"
    r"|^\W*Hier steht (?:der|die|das|ein|ihr|dein) \w+|^\W*(?:Platzhalter|Blindtext|Mustertext)\b"
    r"|^\W*(?:Texte|Description|Résumé|Contenu|Biographie|Chapitre|Critique|Titre) (?:à venir|à compléter|bientôt disponible)"
    r"|^\W*(?:Ici|Insérez|Insérer|Placez) (?:ici )?(?:le|la|votre|un|une) (?:texte|résumé|description|critique|titre)\b"
    r"|^\W*(?:Aquí va|Inserte|Insertar|Escriba|Ponga) (?:aquí )?(?:el|la|su|un|una) (?:texto|descripción|reseña|resumen|título|contenido)"
    r"|^\W*(?:Texto|Descripción|Reseña|Resumen|Contenido|Biografía|Capítulo) (?:próximamente|pendiente|por completar|de relleno)",
    re.I,
)
_SUBJECT = (
    r"(?:the|this|that|your|la|le|die|der|das|el|diese[rs]?|cette|esta?)? ?"
    r"(?:page|site|web ?site|listing|preview|record|chapter|volume|document(?: you asked for)?|review page|request|"
    r"title|book|item|resource|file|content|url|link|service|server|session|account|article|entry|text|catalogue)"
)
_FAILED = (
    r"(?:(?:is|was) (?:not available|unavailable|currently unavailable|down for maintenance|temporarily unavailable|blocked by|"
    r"no longer available|not offered in your|under maintenance)|cannot be (?:displayed|found|opened|loaded|shown)|"
    r"could not be (?:found|displayed|loaded|opened|processed)|(?:has|have) (?:expired|moved or no longer|timed out|been removed|been blocked)|"
    r"failed to load|timed out|returned no data|does not exist|no longer exists)"
)
_STATUS = r"(?:400|401|402|403|404|405|406|408|409|410|413|414|418|421|422|423|429|451|500|501|502|503|504|505|507|508|511|520|521|522|523|524)"
_LEAD = r"^[\W_]*(?:[\w' ]{0,30}\W{1,3})?"
_ERROR = re.compile(
    r"^[\W_]*(?:http (?:status|error)|error(?: code)?|code|status|fehler|erreur|fallo)\s*[:#]?\s*" + _STATUS + r"\b(?! on\b| of\b| in\b)"
    r"|^[\W_]*" + _STATUS + r"\W{1,4}(?:not found|forbidden|unauthori[sz]ed|bad gateway|gateway time-?out|service unavailable|"
    r"internal server error|bad request|too many requests|gone|moved permanently|error|access denied)"
    r"|^[\W_]*(?:page not found|not found|forbidden|bad gateway|gateway time-?out|service unavailable|internal (?:server )?error|bad request|"
    r"access denied|that'?s an error|access to this \w+ (?:is|was|has been) (?:denied|blocked)|something went wrong|an error (?:has )?occurred|"
    r"fatal error|too many requests|permission denied|connection (?:timed out|refused)|we'?re sorry,|whoops|oops)"
    r"(?:\s*\(" + _STATUS + r"\))?\s*(?:$|[.:;,!\-–—(]|from your)"
    r"|^[\W_]*sorry\W{1,4}(?:[\w ]{0,40}" + _FAILED + r"|$|we )"
    r"|^[\W_]*" + _SUBJECT + r" " + _FAILED +
    r"|^[\W_]*seite (?:wurde )?nicht (?:gefunden|verfügbar)|^[\W_]*zugriff (?:verweigert|gesperrt)|^[\W_]*fehler\W{1,3}\d{3}\b"
    r"|^[\W_]*der server antwortet nicht|^[\W_]*(?:ihre )?sitzung ist abgelaufen"
    r"|^[\W_]*page (?:introuvable|non trouvée)|^[\W_]*accès (?:refusé|interdit)|^[\W_]*erreur\W{1,3}\d{3}\b|^[\W_]*(?:votre )?session a expiré"
    r"|^[\W_]*página no (?:encontrada|disponible)|^[\W_]*acceso (?:denegado|prohibido)|^[\W_]*error\W{1,3}\d{3}\W{1,3}(?:la|el|no|página)\b|^[\W_]*(?:su )?sesión ha (?:caducado|expirado)"
    r"|^[\W_]*you (?:do not|don'?t) have (?:permission|access|authori[sz]ation) to"
    r"|^[\W_]*you have reached your (?:limit|quota)|^[\W_]*you (?:are|have been) (?:blocked|not authori[sz]ed)"
    r"|^[\W_]*your (?:session|ip address|network|access|account) (?:has|was|is) (?:expired|timed out|blocked|been blocked|suspended|been suspended|denied)"
    r"|^[\W_]*(?:verify|confirm|prove) (?:that )?you are (?:a |not a )?(?:human|robot)"
    r"|^[\W_]*checking (?:your|the) (?:browser|connection)"
    r"|^[\W_]*(?:complete|solve) the (?:captcha|puzzle) "
    r"|^[\W_]*(?:subscribe|sign in|log in|register) (?:again )?to (?:continue|read|view|unlock)\b.{0,40}[.!]?$"
    r"|^[\W_]*this (?:title|page|book|content|site) is not (?:offered|available) in your (?:country|region)"
    r"|^[\W_]*(?:the )?(?:site|service|catalogue|page) is (?:down|closed|offline) for (?:scheduled )?maintenance",
    re.I,
)
_TRACE = re.compile(
    r"\b\w+(?:Exception|SyntaxError|TypeError|ValueError|KeyError|NameError|RuntimeError)\b\s*(?::|at |in )"
    r"|^\s*(?:Traceback \(most recent call last\)|Exception in thread|Stack trace:)"
    r"|^\s*File \"[^\"]+\", line \d+, in "
    r"|\bundefined (?:index|variable|offset|method|property)\b\W{0,3}.{0,60}\b(?:in|on line)\b"
    r"|^\s*(?:Warning|Notice|Fatal error|Parse error|Deprecated)\s*:\s.{0,160}\b(?:on line \d+|in /|could not connect|timeout|exhausted|database)"
    r"|^\s*ORA-\d{3,5}:|\bSQLSTATE\[|^\s*Stack overflow in module\b|\bat [\w.$]+\([\w]+\.(?:java|cs|js|py):\d+\)"
    r"|\bSegmentation fault\b|^\s*panic: ",
    re.M,
)
_SCRIPT = (
    r"(?:java ?script|js|(?:(?:client-side|active|browser) )?script(?:s|ing)?|cookies|scripts? (?:and|or) cookies)"
)
_NOTICE = re.compile(
    r"^[\W_]*(?:please|kindly|you (?:must|need to|have to|should)|to (?:continue|view|read|use)[^.]{0,60},? (?:please )?)?\s*"
    r"(?:activate|enable|switch on|turn on|allow) " + _SCRIPT + r"\b(?! (?:last|first)\b)"
    r"|\b(?:your|this) browser (?:has|does not|doesn'?t|is|currently) (?:disabled|blocked|blocking|support|not support|turned off|switched off|set to block)\W{1,2}?.{0,12}" + _SCRIPT +
    r"|^[\W_]*without " + _SCRIPT + r",? (?:the|this|our|your|some|most) .{0,40}\b(?:stays?|cannot|can'?t|will not|won'?t|(?:is|are) (?:hidden|empty|not shown))"
    r"|^[\W_]*(?:this|the|our) (?:page|site|reader|catalogue|book|viewer|app|application|preview|chapter) (?:works only with|requires|needs|will not work without|does not work without|only works with) " + _SCRIPT +
    r"|^[\W_]*" + _SCRIPT + r" (?:is|are|must be|has to be|seems? to be|needs? to be) (?:required|disabled|turned off|switched off|blocked|enabled|switched on|turned on|needed)"
    r"|^[\W_]*(?:bitte )?(?:aktivieren|erlauben) sie (?:bitte )?(?:javascript|skripte|scripting)|^[\W_]*bitte javascript (?:aktivieren|einschalten|erlauben)|^[\W_]*ihr browser (?:unterstützt|blockiert|hat)\b.{0,30}(?:javascript|skripte)"
    r"|^[\W_]*javascript (?:muss|ist|wird)\b.{0,20}(?:aktiviert|deaktiviert|benötigt|ausgeschaltet)"
    r"|^[\W_]*(?:veuillez|merci d'|vous devez) ?(?:activer|autoriser) (?:javascript|les scripts)|^[\W_]*votre navigateur\b.{0,40}(?:javascript|scripts)"
    r"|^[\W_]*(?:por favor,? )?(?:active|activa|habilite|permita|debe activar) (?:javascript|los scripts)|^[\W_]*su navegador\b.{0,40}(?:javascript|scripts)",
    re.I,
)
# Fixed value: share of a part that a message which does not start it must cover; less is a clause of a sentence about something else.
_SHARE = 0.3

# Cheap literal needles of each grammar, all lower case; a part is held against
# a grammar only if it contains one of the grammar's needles.
_NEEDLES = {
    "placeholder": "{ <% @@ << <!-- __ % # [".split(),
    "rendered": [
        "object object", "#ref!", "#n/a", "#value!", "#name?",
        *(f"{a}{v}{b}" for v in ("undefined", "null", "nan", "none", "nil") for a, b in (
            (": ", ""), (":", ""), ("", " by"), ("", " rat"), ("", " rev"), ("", " pag"), ("", " star"), ("", " vot"),
            ("by ", ""), ("ed ", ""), ("written ", ""), ("isbn ", ""), ("year ", ""), ("price ", ""))),
    ],
    "trace": [
        "exception", "syntaxerror", "typeerror", "valueerror", "keyerror", "nameerror", "runtimeerror", "traceback", "stack trace",
        'file "', "undefined", "warning", "notice", "fatal error", "parse error", "deprecated", "ora-", "sqlstate",
        "stack overflow", "segmentation", "panic", ".java:", ".cs:", ".js:", ".py:",
    ],
    "filler": [
        "lorem", "ipsum", "adipiscing", "consectetur", "eiusmod", "incididunt", "ullamco", "coming soon", "to follow", "to come",
        "pending", "goes here", "in this space", "not yet", "dummy", "placeholder", "enter your", "add your", "type your", "put your",
        *(f"{a} {t}" for t in _THINGS for a in ("your", "sample", "test", "filler", "enter", "add", "put", "type", "write")),
        *(f"{t} {b}" for t in _THINGS for b in ("here", "missing", "below")),
        "tbd", "tba", "todo", "fixme", "n/a", "xxx", " folgt", "hier steht", "platzhalter", "blindtext", "mustertext", "venir",
        "à compléter", "bientôt", "le texte", "votre texte", "aquí va", "insert", "escriba", "ponga", "próximamente", "pendiente",
        "por completar", "de relleno", "blah", "na", "is here", "is missing", "insérez", "insérer", "placez", "ici ", "nostrud", "laboris", "aliqua", "consequat",
    ],
    "script": ["script", "js", "cookies", "skripte"],
    "error": [
        "error", "not found", "forbidden", "gateway", "unavailable", "not available", "bad request", "denied", "went wrong",
        "too many requests", "timed out", "time-out", "timeout", "sorry", "whoops", "oops", "maintenance", "blocked", "cannot be",
        "could not", "expired", "no longer", "failed to", "returned no", "does not exist", "gefunden", "verfügbar", "verweigert",
        "gesperrt", "fehler", "antwortet", "abgelaufen", "introuvable", "non trouvée", "refusé", "interdit", "erreur", "expiré",
        "no encontrada", "no disponible", "denegado", "prohibido", "caducado", "expirado", "fallo", "permission", "authorised", "authorized", "authorisation", "authorization",
        "reached your", "suspended", "a human", "a robot", "captcha", "puzzle", "checking", "subscribe", "sign in", "log in",
        "register", "not offered", "status", "code:", "code 4", "code 5", "offline", "have access", "are human", "are robot", "refused", "gone", "moved perm", "been removed", "code",
    ],
}


@lru_cache(maxsize=1)
def _automaton():
    import ahocorasick

    kinds: dict[str, set[str]] = {}
    for kind, needles in _NEEDLES.items():
        for n in needles:
            kinds.setdefault(n, set()).add(kind)
    a = ahocorasick.Automaton()
    for n, ks in kinds.items():
        a.add_word(n, frozenset(ks))
    a.make_automaton()
    return a


def _lower(text: str) -> str:
    low = text.lower()
    if len(low) != len(text):  # letters whose lower case is longer
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    return low


def _suspect_lines(text: str) -> Iterator[tuple[str, set[str]]]:
    """Lines of ``text`` with needles, and the grammars these belong to."""
    at, end, kinds = -1, -1, set()
    for pos, ks in _automaton().iter(_lower(text)):
        if pos >= end:
            if kinds:
                yield text[at:end], kinds
            at = text.rfind("\n", 0, pos) + 1
            end = text.find("\n", pos)
            end = len(text) if end < 0 else end
            kinds = set()
        kinds |= ks
    if kinds:
        yield text[at:end], kinds


def _latin(part: str) -> bool:
    """Pseudo-Latin: most words of the part, or a run of eight or more."""
    tokens = re.findall(r"[^\W\d_]+", part.lower())
    latin = [t in _LOREM for t in tokens]
    if len(tokens) >= 5 and sum(latin) >= 0.7 * len(tokens) and len({t for t in tokens if t in _LOREM_MARK}) >= 2:
        return True
    run, marks = 0, set()
    for t, is_latin in zip(tokens, latin):
        if not is_latin:
            run, marks = 0, set()
            continue
        run += 1
        if t in _LOREM_MARK:
            marks.add(t)
        if run >= 8 and len(marks) >= 3:
            return True
    return False


def _repeats(text: str) -> bool:
    """One token of two or more characters four times in a row."""
    w = text.split()
    for a, b, c, d in zip(w, w[1:], w[2:], w[3:]):
        if a == b and b == c and (c == d or c == d.rstrip(".,;!?")) and len(a) > 1 and a[0].isalnum():
            return True
    return False


def _kind_of(part: str, kinds: set[str]) -> str | None:
    about = None
    if "placeholder" in kinds:
        about = _ABOUT.search(part)
        strong = [*_STRONG.finditer(part), *_STRONG_ANYCASE.finditer(part)]
        if strong:
            covered = sum(m.end() - m.start() for m in strong)
            # A sentence about the notation holds few of them among many words.
            if not (about and covered < 0.25 * len(part) and len(part.split()) >= 8):
                return "placeholder"
        elif not about and _WEAK.search(part):
            return "placeholder"
    if "rendered" in kinds and _RENDERED.search(part):
        return "rendered"
    if "trace" in kinds and _TRACE.search(part):
        return "trace"
    # Filler and error messages start their part by their grammars.
    if "filler" in kinds and (_latin(part) or _FILLER.search(part)):
        return "filler"
    if "script" in kinds and any(not re.search(r"\w", part[: m.start()]) or m.end() - m.start() >= _SHARE * len(part) for m in _NOTICE.finditer(part)):
        return "script"
    if "error" in kinds and _ERROR.search(part):
        return "error"
    return None


def residue_kind(text: str | None) -> str | None:
    """The first kind of residue found in ``text``, else None.

    Null and blank texts are no residue (there is nothing to exclude).
    """
    if not text or not text.strip():
        return None
    body = text.replace("\u200b", "").replace("\xa0", " ")
    if "`" in body or "~~~" in body:
        body = _INLINE.sub(" ", _FENCE.sub(" ", body))
    for line, kinds in _suspect_lines(body):
        parts = [p for p in _SENTENCE.split(line) if p.strip()]
        for part in [line, *parts] if len(parts) > 1 else parts:
            if kind := _kind_of(part, kinds):
                return kind
    if _repeats(body):
        return "filler"
    return None


def detect_residue(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row ``(id_col, kind)`` per document with residue.

    Whole texts are scanned.  Null or blank texts give no row; repeated rows
    give one row per id and kind; other columns of ``docs`` are ignored, so
    clashing names are harmless; an empty table gives an empty result.
    """
    slim = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).where(F.col("_text").isNotNull())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf = pdf.assign(kind=[residue_kind(t) for t in pdf["_text"]])
            yield pdf.loc[pdf["kind"].notna(), ["_id", "kind"]]

    schema = f"_id {dict(slim.dtypes)['_id']}, kind string"
    return slim.mapInPandas(run, schema).select(F.col("_id").alias(id_col), "kind").distinct()


def drop_residue(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that :func:`detect_residue` reports."""
    bad = detect_residue(docs, id_col, text_col).select(F.col(id_col).alias("_bad")).distinct()
    return docs.join(bad, docs[id_col] == bad["_bad"], "left_anti")
