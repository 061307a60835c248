"""Numbers in words, and units of measurement, as typed placeholders need them.

Both are public lists: the SI prefixes and units, customary units, units of time and data, and currencies.
Names and symbols of units are made by the rule prefix x base; plurals are added by rule.
"""

from __future__ import annotations

import re

# Fixed values.
ONES = "one two three four five six seven eight nine".split()
TEENS = "ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen".split()
TENS = "twenty thirty forty fifty sixty seventy eighty ninety".split()
SCALES = "thousand million billion trillion quadrillion quintillion dozen".split()
ORDINAL_ONES = "first second third fourth fifth sixth seventh eighth ninth".split()
ORDINAL_OTHERS = "twelfth twentieth thirtieth fortieth fiftieth sixtieth seventieth eightieth ninetieth".split()
PREFIX_NAMES = (
    "quecto ronto yocto zepto atto femto pico nano micro milli centi deci deca deka hecto kilo mega giga tera peta exa zetta yotta ronna quetta"
).split()
PREFIX_SYMBOLS = "q r y z a f p n u µ μ m c d da h k M G T P E Z Y R Q".split()
BASE_NAMES = (
    "metre meter gram gramme litre liter second ampere amp kelvin mole candela hertz newton pascal joule watt coulomb volt farad ohm "
    "siemens weber tesla henry lumen lux becquerel sievert katal tonne bit byte electronvolt bel calorie"
).split()
BASE_SYMBOLS = "m g s A K mol cd Hz N Pa J W C V F Ω S Wb T H lm lx Bq Gy Sv kat l L t eV B b bit dB cal m2 m3 m² m³ Wh bps".split()
BINARY_SYMBOLS = [f"{p}{b}" for p in "ki mi gi ti pi ei zi yi".split() for b in ("b", "bit")]
BINARY_NAMES = [f"{p}byte" for p in "kibi mebi gibi tebi pebi exbi zebi yobi".split()]
CUSTOMARY = (
    "inch mile league furlong chain fathom yard acre hectare ounce pound ton grain dram pint quart gallon cup teaspoon tablespoon barrel "
    "bushel peck stone rod knot carat hogshead gill minim horsepower foot bar atmosphere torr psi degree celsius fahrenheit radian "
    "percent point dioptre angstrom parsec lightyear are gray"
).split()
CUSTOMARY_SYMBOLS = "in ft yd mi nmi oz lb lbs st cwt pt qt gal tsp tbsp fl bbl mph kmh kph fps rpm hp bhp ha ac sq cu °c °f °k deg pct ppm ppb atm mmhg km/h m/s kwh".split()
TIMES = "minute hour day week fortnight month year decade century millennium night".split()
TIME_SYMBOLS = "min mins h hr hrs sec secs d wk wks mo mos yr yrs am pm".split()
CURRENCIES = (
    "dollar cent euro pound pence penny shilling yen rupee paisa yuan renminbi peso franc krona krone rouble ruble kopeck real won rand lira dinar "
    "dirham riyal rial shekel zloty forint baht ringgit rupiah dong taka naira cedi peseta mark crown guilder florin hryvnia leu lev kuna tenge som "
    "bolivar sol quetzal colon buck quid nickel dime quarter"
).split()
CURRENCY_SYMBOLS = (
    "usd eur gbp jpy cny chf cad aud nzd inr krw brl mxn ars clp cop pen zar sek nok dkk pln czk huf ron bgn try rub uah ils sar aed egp thb sgd "
    "hkd twd idr myr php vnd ngn kes"
).split()
IRREGULAR = {"foot": "feet", "inch": "inches", "century": "centuries", "penny": "pennies", "krona": "kronor", "krone": "kroner", "real": "reais", "millennium": "millennia", "hertz": "hertz", "siemens": "siemens", "lux": "lux"}
#: Names that are common words too: units only where a number or "per" stands before them.
COMMON = frozenset(
    "second seconds mole moles bit bits bel bels chain chains league leagues rod rods stone stones grain grains cup cups foot yard yards peck pecks "
    "knot knots bar bars degree degrees point points are ares gray grays real won mark marks crown crowns sol som colon buck bucks quarter quarters "
    "dime dimes nickel nickels night nights day days week weeks month months year years minute minutes hour hours pound pounds leu lev rand lira "
    "atmosphere barrel barrels ton tons gill gills minim minims dong guilder florin newton newtons kelvin henry pascal joule tesla weber ohm "
    "decade decades century centuries mile miles inch inches feet pint pints".split()
)

NUMBER, ONE, TEEN, TEN, HUNDRED, SCALE = range(1, 7)
#: Number words by their place in the grammar; whether one may go on a number that another ended.
WORDS = {**dict.fromkeys(ONES, ONE), **dict.fromkeys(TEENS, TEEN), **dict.fromkeys(TENS, TEN), **dict.fromkeys(SCALES, SCALE), "hundred": HUNDRED, "zero": NUMBER}
GOES_ON = {(TEN, ONE)} | {(a, HUNDRED) for a in (NUMBER, ONE, TEEN, TEN)} | {(a, SCALE) for a in (NUMBER, ONE, TEEN, TEN, HUNDRED)}
GOES_ON |= {(a, b) for a in (HUNDRED, SCALE) for b in (ONE, TEEN, TEN)}
ORDINALS = frozenset(
    [*ORDINAL_ONES, *ORDINAL_OTHERS, "hundredth", "thousandth", "millionth", "billionth", "last"] + [t + "th" for t in TEENS if t != "twelve"]
) - {"last"}
DIGIT_ORDINAL = re.compile(r"\d+(st|nd|rd|th)")


def _plural(name: str) -> str:
    return IRREGULAR.get(name) or (name + "es" if name.endswith(("s", "x", "z", "ch")) else name + "s")


def unit_words() -> tuple[frozenset[str], frozenset[str]]:
    """Lower-case words that are always units, and those that are units after a number or "per" only."""
    names = {*BASE_NAMES, *(p + b for p in PREFIX_NAMES for b in BASE_NAMES), *BINARY_NAMES, *CUSTOMARY, *TIMES, *CURRENCIES}
    names |= {_plural(n) for n in names}
    symbols = {*BASE_SYMBOLS, *(p + b for p in PREFIX_SYMBOLS for b in BASE_SYMBOLS), *BINARY_SYMBOLS, *CUSTOMARY_SYMBOLS, *TIME_SYMBOLS, *CURRENCY_SYMBOLS}
    after = {s.lower() for s in symbols} | COMMON
    return frozenset(names - after), frozenset(after)


def number_class(word: str) -> int:
    """The class of a lower-case number word, also of a compound with hyphens, or 0."""
    if word in WORDS:
        return WORDS[word]
    parts = [p for p in word.split("-") if p != "and"]
    if len(parts) < 2 or any(p not in WORDS for p in parts):
        return 0
    kinds = [WORDS[p] for p in parts]
    return kinds[-1] if all(pair in GOES_ON for pair in zip(kinds, kinds[1:])) else 0


def is_ordinal(word: str) -> bool:
    head, _, tail = word.rpartition("-")
    return bool(DIGIT_ORDINAL.fullmatch(word)) or (tail in ORDINALS and (not head or number_class(head) > 0))
