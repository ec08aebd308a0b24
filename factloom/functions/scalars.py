"""Column functions: names, ids, clocks, marks, dates, addresses, CSV cells. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Letters that names are folded from and to, and the suffixes that a school name loses; fixed values.
FOLD_FROM = "áàâäãåāéèêëēęíìîïīóòôöõōøúùûüūñńçćšśžźżýÿłæœß"
FOLD_TO = "aaaaaaaeeeeeeiiiiiooooooouuuuunnccsszzzyylaos"
SUFFIXES = ("high school", "hs", "highschool", "school", "sr high", "senior high")
#: Result tokens without a mark; fixed values.
TERMINAL = ("DQ", "DNF", "DNS", "NH", "FOUL", "NM", "NT", "SCR")
AMBIGUOUS = ("X", "--")
#: Mail domains of consumers rather than institutions; fixed values.
CONSUMER_DOMAINS = ("gmail.com", "googlemail.com", "hotmail.com", "outlook.com", "live.com", "msn.com", "yahoo.com", "aol.com", "icloud.com", "me.com", "protonmail.com", "proton.me", "comcast.net", "sbcglobal.net", "att.net", "verizon.net", "ymail.com", "mail.com", "aim.com", "earthlink.net", "juno.com", "rr.com", "cox.net", "windstream.net", "centurytel.net", "frontier.com")


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


#: White space of any script, as names are split at it.
WHITE = r"\s\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def normalize_name(name: Column | str) -> Column:
    """Lower case, folded, separators as one space, other symbols gone, institutional suffixes cut.

    Suffixes go one after the other from the end, the longer of two that fit first; the first word stays.
    """
    low = F.translate(F.lower(_c(name)), FOLD_FROM, FOLD_TO)
    spaced = F.regexp_replace(low, rf"[-'.,/{WHITE}]+", " ")
    plain = F.trim(F.regexp_replace(F.regexp_replace(spaced, r"[^0-9a-z ]", ""), " +", " "))
    backwards = "|".join(s[::-1] for s in SUFFIXES)
    return F.reverse(F.regexp_replace(F.reverse(plain), f"^(?:(?:{backwards}) )+", ""))


def flip_last_first(name: Column | str) -> Column:
    """"Last, First" as "First Last"; anything else trimmed."""
    return F.regexp_replace(F.trim(_c(name)), r"^([^,]*[^,\s])\s*,\s*(\S.*)$", "$2 $1")


def compressed(text: Column | str) -> Column:
    return F.lower(F.regexp_replace(_c(text), "[^0-9A-Za-z]", ""))


def clean_text(text: Column | str) -> Column:
    return F.trim(F.regexp_replace(_c(text), r"[\s\x{a0}\x{2000}-\x{200b}\x{3000}]+", " "))


def escape_part(part: Column | str) -> Column:
    """Delimiter bytes inside a part are escaped, so different parts never make the same id."""
    out = _c(part).cast("string")
    for code in (0x1D, 0x1E, 0x1F):
        out = F.replace(out, F.lit(chr(code)), F.lit(chr(0x1D) + chr(code + 0x40)))
    return F.coalesce(out, F.lit(""))


def mint_id(prefix: str, *parts: Column | str) -> Column:
    """prefix_ and the first 8 bytes of the SHA-256 of the delimited, escaped parts."""
    body = F.concat_ws(chr(0x1F), F.lit(prefix), *[escape_part(p) for p in parts])
    return F.concat(F.lit(prefix + "_"), F.substring(F.sha2(body, 256), 1, 16))


def set_digest(items: Column | str) -> Column:
    """A digest of an array as a set: order and repeats don't matter."""
    return F.sha2(F.array_join(F.array_sort(F.array_distinct(_c(items))), chr(0x1F)), 256)


CLOCK = r"^(?:(?:(\d+):)?(\d+):)?(\d+)(?:\.(\d{1,9}))?$"


def parse_clock_ns(text: Column | str) -> Column:
    """[[h:]m:]s[.fff] as nanoseconds; null unless positive and in range.

    Seconds are below 60 after a colon, minutes after an hour; alone they may be more.
    """
    t = F.trim(_c(text))
    ok = t.rlike(CLOCK)
    number = lambda k: F.when(F.regexp_extract(t, CLOCK, k) != "", F.regexp_extract(t, CLOCK, k)).otherwise("0").try_cast("decimal(38,0)")
    has = lambda k: F.regexp_extract(t, CLOCK, k) != ""
    whole = (number(1) * 60 + number(2)) * 60 + number(3)
    value = (whole.cast("decimal(28,0)") * F.lit(1_000_000_000) + F.rpad(F.regexp_extract(t, CLOCK, 4), 9, "0").try_cast("long")).try_cast("long")
    fits = (~has(1) | (number(2) < 60)) & (~has(2) | (number(3) < 60)) & (value > 0)
    return F.when(ok & fits, value)


def format_clock(ns: Column | str, digits: int = 2) -> Column:
    """h:mm:ss.ff, m:ss.ff or s.ff with the precision given; the value is cut, not rounded."""
    n = _c(ns)
    total = ((n - F.pmod(n, F.lit(1_000_000_000))) / F.lit(1_000_000_000)).cast("long")
    s, m, h = F.pmod(total, F.lit(60)), F.pmod(F.floor(total / 60).cast("long"), F.lit(60)), F.floor(total / 3600).cast("long")
    fraction = F.substring(F.lpad(F.pmod(n, F.lit(1_000_000_000)).cast("string"), 9, "0"), 1, digits)
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    head = F.when(h > 0, F.concat(h.cast("string"), F.lit(":"), two(m), F.lit(":"), two(s))).when(m > 0, F.concat(m.cast("string"), F.lit(":"), two(s))).otherwise(s.cast("string"))
    return F.concat(head, F.lit("."), fraction) if digits else head


FEET = r"""^(\d+)(?:-|' ?)(\d{1,2})(?:\.(\d{1,2}))?"?$"""


def parse_feet_um(text: Column | str) -> Column:
    """19-00.25 or 19' 0.25" as micrometres (1/100 inch is 254); null off that grid or from 12 inches."""
    t = F.trim(_c(text))
    ok = t.rlike(FEET)
    part = lambda k: F.regexp_extract(t, FEET, k)
    hundredths = F.rpad(part(3), 2, "0")
    number = lambda c: F.when(ok & (c != ""), c).otherwise("0").cast("long")
    inches = number(part(2))
    return F.when(ok & (inches < 12), ((number(part(1)) * 12 + inches) * 100 + number(hundredths)) * 254)


def timing_suffix(mark: Column | str) -> Column:
    """fat, hand or unknown from a mark's last letter."""
    t = F.lower(F.trim(_c(mark)))
    return F.when(t.rlike(r"\da$"), "fat").when(t.rlike(r"\dh$"), "hand").otherwise("unknown")


def result_status(token: Column | str) -> Column:
    t = F.upper(F.trim(_c(token)))
    return F.when(t.isin(*TERMINAL), "terminal").when(t.isin(*AMBIGUOUS), "ambiguous").otherwise("mark")


def wind_class(wind: Column | str, applies: Column | bool = True) -> Column:
    w = _c(wind)
    return F.when(~F.lit(applies) if isinstance(applies, bool) else ~applies, "n/a").when(w.isNull() | F.isnan(w), "unknown").when(w <= 2.0, "legal").otherwise("assisted")


def school_year(date: Column | str) -> Column:
    """The year a school year opens: August starts a new one."""
    return F.year(_c(date)) - (F.month(_c(date)) < 8).cast("int")


def year_label(start: Column | str) -> Column:
    s = _c(start)
    return F.concat(s.cast("string"), F.lit("-"), F.lpad(F.pmod(s + 1, F.lit(100)).cast("string"), 2, "0"))


def graduation_year(start: Column | str, grade: Column | str) -> Column:
    """Null outside grades 9 to 12 and years 2020 to 2040."""
    g, y = _c(grade), _c(start) + 13 - _c(grade)
    return F.when(g.between(9, 12) & y.between(2020, 2040), y)


def published_date(text: Column | str) -> Column:
    """ISO, US and worded dates; null if none fits."""
    t = F.trim(_c(text))
    guarded = lambda pattern, form: F.when(t.rlike(pattern), F.try_to_date(t, form))
    return F.coalesce(guarded(r"^\d{4}-\d{2}-\d{2}$", "yyyy-MM-dd"), guarded(r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"), guarded(r"^[A-Z][a-z]{2} \d{1,2}, \d{4}$", "MMM d, yyyy"))


def email_class(mail: Column | str) -> Column:
    """consumer, institution or invalid (other than one @ between two parts); a subdomain of a consumer domain is one too."""
    m = F.lower(F.trim(_c(mail)))
    consumer = F.substring_index(m, "@", -1).rlike(r"(^|\.)(" + "|".join(d.replace(".", r"\.") for d in CONSUMER_DOMAINS) + ")$")
    return F.when(~m.rlike(r"^[^@]+@[^@]+$"), "invalid").when(consumer, "consumer").otherwise("institution")


def csv_protect(cell: Column | str) -> Column:
    """A quote before cells that a spreadsheet would read as a formula."""
    c = _c(cell)
    return F.when(c.rlike(r"^[\s\x00-\x1f]*[=+@-]"), F.concat(F.lit("'"), c)).otherwise(c)


def share_percent(part: Column | str, whole: Column | str) -> Column:
    """floor(100 * part / whole); null if whole is 0."""
    return F.floor(F.try_divide(_c(part) * 100, _c(whole))).cast("long")


def coordinate(text: Column | str) -> Column:
    """Seven-decimal fixed point; null if it is no number or out of range."""
    return _c(text).try_cast("decimal(10,7)")


def retry_after_seconds(header: Column | str, now: Column) -> Column:
    """Seconds, or an HTTP date as seconds from now; within a day, not negative."""
    h = F.trim(_c(header))
    until = F.when(h.rlike("^[A-Z][a-z]{2}, "), F.try_to_timestamp(F.substring(h, 6, 20), F.lit("dd MMM yyyy HH:mm:ss")))
    value = F.coalesce(F.when(h.rlike(r"^\d{1,9}$"), h).try_cast("long"), F.unix_timestamp(until) - F.unix_timestamp(now))
    return F.when(value.isNotNull(), F.greatest(F.lit(0), F.least(F.lit(86_400), value)))


def normalize_statement(text: Column | str) -> Column:
    """Words without their outer punctuation, lower case, joined by one space."""
    words = F.transform(F.split(F.trim(_c(text)), r"\s+"), lambda w: F.lower(F.regexp_replace(w, "^[^0-9A-Za-z]+|[^0-9A-Za-z]+$", "")))
    return F.array_join(F.filter(words, lambda w: w != ""), " ")


#: Role words that a person's name loses from its end; fixed values.
ROLE_WORDS = ("head coach", "coach", "assistant", "director", "teacher", "principal")


def sanitize_person(text: Column | str) -> Column:
    """The name without trailing role words; null if only a role is left or there is a digit."""
    t = F.trim(F.regexp_replace(F.lower(clean_text(text)), rf"[ ,-]*(({'|'.join(ROLE_WORDS)})[ ,-]*)+$", ""))
    return F.when((t != "") & ~t.rlike("[0-9@]"), t)


def surface_class(kinds: Column | str) -> Column:
    """indoor, outdoor or xc if exactly one of them is named, else unresolved."""
    named = F.array_intersect(_c(kinds), F.array(F.lit("indoor"), F.lit("outdoor"), F.lit("xc")))
    return F.when(F.size(named) == 1, F.element_at(named, 1)).otherwise("unresolved")


def season_label(surface: Column | str) -> Column:
    s = _c(surface)
    return F.when(s == "indoor", "Winter").when(s == "outdoor", "Spring").when(s == "xc", "Fall")


def address_line(street: Column | str, city: Column | str, state: Column | str, postal: Column | str) -> Column:
    """street, city, state postal; absent parts and their separators are left out."""
    tail = F.nullif(F.concat_ws(" ", _c(state), _c(postal)), F.lit(""))
    return F.concat_ws(", ", _c(street), _c(city), tail)


def blocked(cooldown: Column | str, now: Column) -> Column:
    """Whether access waits: a cooldown in the future, or one that can't be read; none given is free."""
    c = _c(cooldown)
    return F.when(c.isNull(), False).otherwise(F.coalesce(F.try_to_timestamp(c) > now, F.lit(True)))


def label_kind(label: Column | str, kinds: dict[str, str], widest: int = 4) -> Column:
    """The kind of a label: the whole compact label, else the widest window of its words that is known.

    A window is looked up in compact form; of equally wide ones the first counts.
    """
    table = F.create_map(*[F.lit(x) for kv in kinds.items() for x in kv])
    words = F.filter(F.split(F.lower(_c(label)), "[^0-9a-z]+"), lambda w: w != "")

    def first_window(k: int) -> Column:
        starts = F.when(F.size(words) >= k, F.sequence(F.lit(1), F.size(words) - (k - 1)))
        hits = F.transform(starts, lambda i: F.try_element_at(table, F.array_join(F.slice(words, i, F.lit(k)), "")))
        return F.try_element_at(F.filter(hits, lambda x: x.isNotNull()), F.lit(1))

    return F.coalesce(F.try_element_at(table, F.array_join(words, "")), *[first_window(k) for k in range(widest, 0, -1)])
