r"""Ordered redaction rules as Column expressions.

R1 mailto links, R2 addresses, R3 spelled-out addresses, R4 passcodes in URLs, R5
labelled passcodes, R6 further copies of what R4 removed. Each rule reads what the
rule before it left. A text is searched for a rule only where a cheap test finds the
rule's sign, and only once: what a rule did is counted by the markers that it left.

Word borders are written for ASCII, since Java's \b follows Unicode. Nulls stay null.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Exempt endings of file names, labels and names of passcodes, least length of a copied secret,
# markers, and the most addresses of an allowlist.
IMAGE_ENDINGS = "png jpg jpeg gif webp svg bmp ico".split()
PASSCODE_LABELS = "kenncode kennwort passcode passwort password zugangscode wachtwoord toegangscode".split()
PASSCODE_PARAMS = "pwd passcode password".split()
LEAST_SECRET = 12
ADDRESS_MARK, LINK_MARK, SECRET_MARK = "[email redacted]", '<span class="email-redacted">', "REDACTED"
MOST_ALLOWED = 100
# Brackets around spelled-out signs.
BRACKETS = [("(", ")"), ("[", "]"), ("{", "}")]

#: A character of the part before @, one of a domain's labels, and where a search for an address may begin: not
#: inside such a part (so that a long run is read once), or right behind the address before it.
_NAME, _LABEL = r"[\w.%+-]", "[A-Za-z0-9-]"
_BEGIN = rf"(?:(?<!{_NAME})|\G(?!^))"
#: The end of a whole address or domain.
_DONE = rf"(?!{_LABEL}|\.[A-Za-z0-9])"
#: A value in a URL ends at white space, quotes, brackets, & and #.
_VALUE = r"[^\s\"'<>&#]"


def _any(words: list[str]) -> str:
    return "(?:" + "|".join(map(re.escape, words)) + ")"


@dataclass(frozen=True)
class Rule:
    id: str
    about: str
    pattern: str
    replacement: str
    mark: str  # what each replacement leaves one of
    sign: str  # a cheap pattern without which the rule can't match


def address_pattern(allowed: tuple[str, ...] = ()) -> str:
    """R2: an address that is no name of an image file and not one of the allowed (whole, in any case)."""
    image = rf"(?!{_NAME}+@(?:{_LABEL}+\.)+(?i:{_any(IMAGE_ENDINGS)}){_DONE})"
    kept = rf"(?!(?i:{_any(sorted(allowed))}){_DONE})" if allowed else ""
    return rf"{_BEGIN}{image}{kept}{_NAME}+@(?:{_LABEL}+\.)+[A-Za-z]{{2,}}"


def rules(allowed: tuple[str, ...] = ()) -> tuple[Rule, ...]:
    return (
        Rule("R1", "mailto link in quotes becomes a marked span", r"(?is)<a\s[^>]*?(?<=\s)href\s*=\s*([\"'])mailto:(?:(?!\1).)*\1[^>]*>(.*?)</a\s*>", LINK_MARK + "$2</span>", LINK_MARK, "(?i)mailto:"),
        Rule("R2", "address, names of image files excepted", address_pattern(allowed), ADDRESS_MARK, ADDRESS_MARK, "@"),
        Rule("R3", "address with at and dot as words in brackets of one kind", SPELLED, ADDRESS_MARK, ADDRESS_MARK, r"(?i)[(\[{][ \t]*dot[ \t]*[)\]}]"),
        Rule("R4", "passcode parameter of a URL", rf"((?<=[?&;])(?i:{_any(PASSCODE_PARAMS)})=)({_VALUE}+)", f"$1{SECRET_MARK}", SECRET_MARK, rf"(?i)[?&;]{_any(PASSCODE_PARAMS)}="),
        Rule("R5", "labelled passcode of 4 to 12 letters and digits, one digit at least", rf"(?i)((?<![A-Za-z0-9_]){_any(PASSCODE_LABELS)}[ \t]*[:=][ \t]*)((?=[a-z]*[0-9])[a-z0-9]{{4,12}})(?![A-Za-z0-9_])", f"$1{SECRET_MARK}", SECRET_MARK, rf"(?i){_any(PASSCODE_LABELS)}[ \t]*[:=]"),
    )


#: A word in brackets of one kind that stands for a sign, with the blanks around it.
SPELLED = "(?i)[ \\t]*(?:" + "|".join(rf"{re.escape(a)}[ \t]*(?:at|dot)[ \t]*{re.escape(b)}" for a, b in BRACKETS) + ")[ \\t]*"

RULES = rules()
R6 = "R6"
NAMES = [*(r.id for r in RULES), R6]


def check_allowlist(entries: list[tuple[str, str]]) -> tuple[str, ...]:
    """The addresses of (address, reason) entries, lower case; a ValueError if there are over MOST_ALLOWED, doubles, malformed ones or entries without reason."""
    if len(entries) > MOST_ALLOWED:
        raise ValueError(f"more than {MOST_ALLOWED} allowed addresses")
    out = []
    for address, reason in entries:
        if not isinstance(address, str) or not re.fullmatch(r"[A-Za-z0-9._%+-]+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}", address):
            raise ValueError("an allowed address is malformed")
        if not isinstance(reason, str) or not reason.strip():
            raise ValueError("an allowed address has no reason")
        if address.lower() in out:
            raise ValueError("an allowed address is listed twice")
        out.append(address.lower())
    return tuple(out)


def bound(c: Column, f) -> Column:
    """f of a value that is computed once, however often f names it (rules nest, so repeats would multiply)."""
    return F.get(F.transform(F.array(c), f), F.lit(0))


def spelled_out(c: Column) -> Column:
    """R3: c cut at the words in brackets and read piece by piece.

    An "at" behind a name opens an address; pieces of labels go on with it as long as a "dot" follows. It is one from the first "dot" on
    that has two letters or more behind it, and reaches as far as the last such. Whatever opens and comes to nothing stays.
    """
    name, letters = rf"{_NAME}+\z", "^[A-Za-z]{2,}"
    text = "cast(null as string)"

    def after(st: Column) -> Column:
        """What the address or text so far comes to, if it ends here."""
        return F.coalesce(st["best"], st["raw"], st["tail"])

    def state(out: Column, tail: Column, raw: Column, best: Column, goes_on: Column) -> Column:
        return F.struct(out.alias("out"), tail.alias("tail"), raw.alias("raw"), best.alias("best"), goes_on.alias("goes_on"))

    def step(st: Column, t: Column) -> Column:
        sign, piece = t["sign"], t["piece"]
        none, labels = F.expr(text), piece.rlike(rf"^{_LABEL}+(?:\.{_LABEL}+)*\z")
        is_at = F.lower(sign).contains("at")
        longer = lambda x: F.concat(x, sign, piece)
        dot = state(
            st["out"], F.lit(""), longer(st["raw"]),
            F.when(piece.rlike(letters), F.concat(F.lit(ADDRESS_MARK), F.regexp_replace(piece, letters, ""))).when(st["best"].isNotNull(), longer(st["best"])), labels,
        )

        def ended(x: Column) -> Column:
            begins = state(F.concat(st["out"], F.array(F.regexp_replace(x, name, ""))), F.lit(""), longer(F.regexp_extract(x, rf"({name})", 1)), none, labels)
            return F.when(is_at & x.rlike(name), begins).otherwise(state(F.concat(st["out"], F.array(x, sign)), piece, none, none, F.lit(False)))

        return F.when(~is_at & st["goes_on"], dot).otherwise(bound(after(st), ended))

    def read(x: Column) -> Column:
        pieces = F.split(x, SPELLED, -1)
        signs = F.regexp_extract_all(x, F.lit(f"({SPELLED})"), F.lit(1))
        both = F.zip_with(signs, F.slice(pieces, F.lit(2), F.size(signs)), lambda a, b: F.struct(a.alias("sign"), b.alias("piece")))
        first = state(F.array().cast("array<string>"), F.get(pieces, F.lit(0)), F.expr(text), F.expr(text), F.lit(False))
        return F.aggregate(both, first, step, lambda st: F.concat(F.array_join(st["out"], ""), after(st)))

    return bound(c, read)


def apply_rule(c: Column, rule: Rule) -> Column:
    done = spelled_out if rule.id == "R3" else lambda x: F.regexp_replace(x, rule.pattern, rule.replacement)
    return bound(c, lambda x: F.when(x.rlike(rule.sign), done(x)).otherwise(x))


def passcodes(c: Column, rule: Rule) -> Column:
    """Values that R4 or R5 takes away from c, in order, repeats too."""
    return F.filter(F.regexp_extract_all(c, F.lit(rule.pattern), F.lit(2)), lambda v: v != SECRET_MARK)


def count_rule(c: Column, rule: Rule) -> Column:
    """Matches of a rule in c, those that it replaces by what is there already left out."""

    def found(x: Column) -> Column:
        if rule.id == "R3":
            return bound(spelled_out(x), lambda y: marks(y, ADDRESS_MARK)) - marks(x, ADDRESS_MARK)
        return F.size(passcodes(x, rule)) if rule.id == "R4" else F.regexp_count(x, F.lit(rule.pattern))

    return bound(c, lambda x: F.when(x.rlike(rule.sign), found(x)).otherwise(F.when(x.isNotNull(), 0)))


def marks(c: Column, mark: str) -> Column:
    return F.floor((F.length(c) - F.length(F.replace(c, F.lit(mark), F.lit("")))) / len(mark)).cast("int")


def slug_form(c: Column) -> Column:
    """Lower case, runs of other characters than letters and digits as one hyphen, none at the ends."""
    return F.btrim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), F.lit("-"))


def secrets(c: Column) -> Column:
    """Distinct values of LEAST_SECRET characters and more that R4 removes from c, longest first."""
    rule = RULES[3]
    long = F.array_distinct(F.filter(passcodes(c, rule), lambda v: F.length(v) >= LEAST_SECRET))
    return F.when(c.rlike(rule.sign), F.array_sort(long, lambda a, b: F.length(b) - F.length(a))).otherwise(F.array().cast("array<string>"))


def _literally(v: Column) -> Column:
    r"""A pattern for the value itself: \Q..\E, with \E in the value taken apart."""
    return F.concat(F.lit("\\Q"), F.replace(v, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))


def remove_copies(c: Column, values: Column) -> Column:
    """R6: what c still holds of the values, whole or as slugs that are long enough, in any case."""

    def gone(text: Column, v: Column) -> Column:
        slug = F.when(F.length(slug_form(v)) >= LEAST_SECRET, F.concat(F.lit("|"), slug_form(v))).otherwise("")
        return F.regexp_replace(text, F.concat(F.lit("(?i)(?:"), _literally(v), slug, F.lit(")")), F.lit(SECRET_MARK))

    return F.when(F.size(values) == 0, c).otherwise(F.aggregate(values, c, gone))


def redact(c: Column, allowed: tuple[str, ...] = ()) -> Column:
    """All rules in order. Allowed whole addresses stay, in any case, but their mailto links go like others."""
    out = c
    for rule in rules(allowed):
        out = apply_rule(out, rule)
    return bound(F.struct(out.alias("t"), secrets(c).alias("v")), lambda s: remove_copies(s["t"], s["v"]))


def rule_counts(df: DataFrame, c: str, allowed: tuple[str, ...] = ()) -> DataFrame:
    """df with n_R1..n_R6 (replacements by each rule in what the rules before it left), src_R1..src_R5 (matches in the source) and redacted."""
    out, before = df.withColumn("_t0", F.col(c)), "_t0"
    own = rules(allowed)
    for k, rule in enumerate(own, 1):
        out = out.withColumn(f"_t{k}", apply_rule(F.col(before), rule))
        before = f"_t{k}"
    out = out.withColumn("_values", secrets(F.col(c)))
    out = out.withColumn("redacted", remove_copies(F.col(before), F.col("_values")))
    steps = [*[(r.id, r.mark, f"_t{k}", f"_t{k + 1}") for k, r in enumerate(own)], (R6, SECRET_MARK, before, "redacted")]
    for id_, mark, a, b in steps:
        out = out.withColumn(f"n_{id_}", F.when(F.col(a) == F.col(b), 0).otherwise(marks(F.col(b), mark) - marks(F.col(a), mark)))
    for rule in own:
        out = out.withColumn(f"src_{rule.id}", count_rule(F.col(c), rule))
    return out.drop("_values", *[f"_t{k}" for k in range(len(own) + 1)])


def email_redacted(c: Column) -> Column:
    """R2 alone."""
    return apply_rule(c, RULES[1])


def residuals(c: Column, allowed: tuple[str, ...] = ()) -> list[Column]:
    """For each rule, whether a redacted text still matches it."""
    return [c.rlike(r.sign) & (count_rule(c, r) > 0 if r.id in ("R3", "R4") else c.rlike(r.pattern)) for r in rules(allowed)]
