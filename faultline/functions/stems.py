"""Spanish suffix stemmer with word regions, after the published Snowball rules for Spanish."""

from __future__ import annotations

import re

# The suffix lists of the published rules.
PRONOUNS = "selas selos sela selo las les los nos me se la le lo".split()
BEFORE_PRONOUN_ACCENTED = ("iéndo", "ándo", "ár", "ér", "ír")
BEFORE_PRONOUN = ("iendo", "ando", "ar", "er", "ir")
STANDARD = {
    "delete": """anza anzas ico ica icos icas ismo ismos able ables ible ibles ista istas oso osa osos osas
        amiento amientos imiento imientos""".split(),
    "ic": "adora ador ación adoras adores aciones ante antes ancia ancias".split(),
    "log": ["logía", "logías"],
    "u": ["ución", "uciones"],
    "ente": ["encia", "encias"],
    "amente": ["amente"],
    "mente": ["mente"],
    "idad": ["idad", "idades"],
    "iv": "iva ivo ivas ivos".split(),
}
Y_ENDINGS = "ya ye yan yen yeron yendo yo yó yas yes yais yamos".split()
E_ENDINGS = "en es éis emos".split()
VERB_ENDINGS = """arían arías arán arás aríais aría aréis aríamos aremos ará aré erían erías erán erás eríais ería eréis
    eríamos eremos erá eré irían irías irán irás iríais iría iréis iríamos iremos irá iré aba ada ida ía ara iera ad ed id
    ase iese aste iste an aban ían aran ieran asen iesen aron ieron ado ido ando iendo ió ar er ir as abas adas idas ías aras
    ieras ases ieses ís áis abais íais arais ierais aseis ieseis asteis isteis ados idos amos ábamos íamos imos áramos
    iéramos iésemos ásemos""".split()
RESIDUAL = "os a o á í ó".split()

_VOWELS = "aeiouáéíóúü"
_PLAIN = str.maketrans("áéíóú", "aeiou")


def _endings(suffixes: list[str]) -> re.Pattern:
    return re.compile("(?:" + "|".join(sorted(suffixes, key=len, reverse=True)) + ")$")


_KIND = {suffix: kind for kind, suffixes in STANDARD.items() for suffix in suffixes}
_STANDARD, _PRONOUN = _endings(list(_KIND)), _endings(PRONOUNS)
_Y, _E, _VERB, _RESIDUAL = map(_endings, (Y_ENDINGS, E_ENDINGS, VERB_ENDINGS, RESIDUAL))
_REGION = re.compile(rf"[{_VOWELS}][^{_VOWELS}]")


def regions(word: str) -> tuple[int, int, int]:
    """Where RV, R1 and R2 begin."""
    n = len(word)
    rv = n
    if n > 2:
        if word[1] not in _VOWELS:
            rv = next((i + 1 for i in range(2, n) if word[i] in _VOWELS), n)
        elif word[0] in _VOWELS:
            rv = next((i + 1 for i in range(2, n) if word[i] not in _VOWELS), n)
        else:
            rv = 3
    first = _REGION.search(word)
    r1 = first.end() if first else n
    second = _REGION.search(word, r1)
    return rv, r1, second.end() if second else n


def _suffix(pattern: re.Pattern, word: str, start: int) -> str | None:
    """The longest suffix of the list within the region that begins at ``start``."""
    found = pattern.search(word, start)
    return found[0] if found else None


def _pronoun(word: str, rv: int) -> str:
    suffix = _suffix(_PRONOUN, word, rv)
    if not suffix:
        return word
    rest = word[: -len(suffix)]
    for accented in BEFORE_PRONOUN_ACCENTED:
        if rest.endswith(accented) and len(rest) - len(accented) >= rv:
            return rest[: -len(accented)] + accented.translate(_PLAIN)
    if any(rest.endswith(s) and len(rest) - len(s) >= rv for s in BEFORE_PRONOUN):
        return rest
    return rest if rest.endswith("yendo") and len(rest) - 5 >= rv and rest[-6:-5] == "u" else word


def _standard(word: str, r1: int, r2: int) -> str | None:
    """The word without a standard suffix, None if it has none that may go."""
    suffix = _suffix(_STANDARD, word, 0)
    if suffix is None:
        return None
    kind, rest = _KIND[suffix], word[: -len(suffix)]

    def without(text: str, *ends: str) -> str:
        """One of the ends goes, if it lies in R2."""
        end = next((e for e in ends if text.endswith(e)), "")
        return text[: len(text) - len(end)] if end and len(text) - len(end) >= r2 else text

    if len(rest) < (r1 if kind == "amente" else r2):
        return None
    if kind == "log":
        return rest + "log"
    if kind == "u":
        return rest + "u"
    if kind == "ente":
        return rest + "ente"
    if kind == "ic":
        return without(rest, "ic")
    if kind == "amente":
        shorter = without(rest, "iv")
        return without(shorter, "at") if shorter != rest else without(rest, "os", "ic", "ad")
    if kind == "mente":
        return without(rest, "ante", "able", "ible")
    if kind == "idad":
        return without(rest, "abil", "ic", "iv")
    return without(rest, "at") if kind == "iv" else rest


def _verb(word: str, rv: int) -> str:
    suffix = _suffix(_Y, word, rv)
    if suffix and word[: -len(suffix)].endswith("u"):
        return word[: -len(suffix)]
    verb, light = _suffix(_VERB, word, rv), _suffix(_E, word, rv)
    if light and (not verb or len(light) >= len(verb)):
        rest = word[: -len(light)]
        return rest[:-1] if rest.endswith("gu") else rest
    return word[: -len(verb)] if verb else word


def _residual(word: str, rv: int) -> str:
    suffix = _suffix(_RESIDUAL, word, rv)
    if suffix:
        return word[: -len(suffix)]
    if word[-1:] in ("e", "é") and len(word) - 1 >= rv:
        word = word[:-1]
        if word.endswith("gu") and len(word) - 1 >= rv:
            word = word[:-1]
    return word


def spanish_stem(word: str) -> str:
    """The stem of a lower-cased word; accents on vowels are dropped."""
    rv, r1, r2 = regions(word)
    attached = _pronoun(word, rv)
    stemmed = _standard(attached, r1, r2)
    if stemmed is None:
        stemmed = _verb(attached, rv)
    return _residual(stemmed, rv).translate(_PLAIN)
