"""HTML to GitHub-flavoured Markdown with built-in string expressions.

Lists and tables are converted from the inside out, one level of nesting in a pass; what
an inner one becomes holds no tags, so it does not end an outer one. Nested lists are
indented below their item; a table in a cell becomes lines of that cell, since Markdown
has no nested tables. Not a full HTML parser: attribute values that hold angle brackets
and nesting beyond ``DEPTH`` degrade to their text. Every pattern is linear: what
it repeats are single characters, possessively and never across the next ``<``, or
lazily up to an end that is always found.

Most of a text are runs of words that no pattern looks into. They are taken out first,
and numbers stand for them until the marks are Markdown, so that the patterns pass over
the tags and little else.

A page of a document ends at a form feed, or before an element whose style says so.
"""

from __future__ import annotations

from functools import reduce
from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docmill.functions.bind import let

# Comments, scripts and styles go before the head, whose end they might fake.
_DROPPED = [
    r"(?is)<(?:!--.*?(?:-->|\z)|script\b[^<>]*+>.*?(?:</script\s*+>|\z)"
    r"|style\b[^<>]*+>.*?(?:</style\s*+>|\z))",
    r"(?is)<head(?:\s[^<>]*+)?+>.*?(?:</head\s*+>|\z)",
]

# What is dropped above begins like this; other text is looked through once instead of twice.
_TO_DROP = r"!--|script\b|style\b|head[\s>]"

_BLOCKS = (
    "p|div|ul|ol|section|article|nav|header|footer|main|aside|pre|form|table|hr|"
    "dl|dt|dd|figure|figcaption|address|body|html|h[1-6]"
)

# Control characters, which no HTML text may hold, stand for what later steps turn
# into Markdown, so that they are told from the same characters in a text.
_HEADING, _HREF, _LABEL, _LINK_END = "\u0001", "\u0002", "\u0003", "\u0004"
_BULLET, _QUOTE, _CELL_BREAK = "\u0010", "\u0011", "\u0012"
_KEPT_LINE, _KEPT_SPACE, _KEPT_TAB, _FENCE = "\u000e", "\u000f", "\u0013", "\u0014"
_PAGE, _ROW, _NEXT_CELL, _ROW_END = "\u0015", "\u0016", "\u0017", "\u0018"
_RULE, _DASHES, _BAR = "\u0019", "\u001a", "\u001b"
_LIST, _LIST_END, _ITEM = "\u001d", "\u001f", "\u001e"

_ALL = 1 << 30

#: Levels of lists, or of tables, that are told apart.
DEPTH = 5

# Around the number of a run of words; with nothing inside it is that character itself.
_RUN = "\u0005"

# All that patterns look for in a text, or that a character reference has; one by one, as
# ranges make a class several times slower.
_SPECIAL = "".join(rf"\x{n:02x}" for n in [*range(32), *range(127, 160), *map(ord, "<>&|]:;#+-")])

# Words between single spaces, behind a tag or at the start of a text: between "<" and ">"
# nothing is taken. 16 characters are more than any name of a reference has. No run begins
# with a digit, as a heading's mark has one, and none ends a line.
_WORDS = (
    rf"((?:>|\G)(?:(?![^ 0123456789{_SPECIAL}][^{_SPECIAL}]{{15}})[^<>])*+)"
    rf"((?>[^ {_SPECIAL}]+)(?: (?>[^ {_SPECIAL}]+))*+)(?<![\u2028\u2029])"
)

# Where a "<" is not closed before the next one, what later steps drop in between may make a
# tag of what was text.
_NOT_CLOSED = r"[^<>]*+(?:<|\z)"

# Written as text this would be taken for the data of an image, whose white space goes.
_DATA_IN_TEXT = "(?:<[^<>]*+>)*+".join([r"\]", r"\(", "d", "a", "t", "a", ":"])


def _attribute(name: str) -> str:
    """Everything of a tag up to the value of an attribute, which is one of three groups."""
    value = r"""(?:"([^"<>]*+)"|'([^'<>]*+)'|([^\s"'<>]++))"""
    return rf"(?:[^<>\s]|\s(?!{name}\s*+=))*+\s{name}\s*+=\s*+{value}"


# Before white space is collapsed, as a form feed is white space.
_PAGE_STARTS = r"(?i)<(?=[a-z][^<>]*?(?:page-)?break-before\s*+:\s*+(?:always|page|left|right))"

_INLINE = [
    (r"(?i)<br\s*+/?+>", "\n"),
    (r"(?i)<code(?:\s[^<>]*+)?+>([^<]++)</code\s*+>", "`$1`"),
    (r"(?i)<(?:i|em)(?:\s[^<>]*+)?+>([^<]++)</(?:i|em)\s*+>", "*$1*"),
    (r"(?i)<(?:b|strong)(?:\s[^<>]*+)?+>([^<]++)</(?:b|strong)\s*+>", "**$1**"),
    (r"(?i)<(?:i|em)(?:\s[^<>]*+)?+>([^<]++)</(?:i|em)\s*+>", "*$1*"),
]

# A link's text may hold other tags: its two tags are marked on their own.
_LINKS = [
    (rf"(?i)<a(?=\s){_attribute('href')}[^<>]*+>", f"{_HREF}$1$2$3{_LABEL}"),
    (r"(?i)</a\s*+>", _LINK_END),
    (
        rf"{_HREF}([^{_HREF}{_LABEL}]*+){_LABEL}([^{_HREF}{_LINK_END}]*+){_LINK_END}",
        "[$2]($1)",
    ),
    (f"{_HREF}[^{_LABEL}]*+{_LABEL}|{_LINK_END}", ""),
]

_IMAGES = [
    (
        rf"(?i)<img(?=[\s/>])(?={_attribute('src')})(?=(?:{_attribute('alt')})?+)[^<>]*+>",
        "![$4$5$6]($1$2$3)",
    ),
    # data may be broken into lines, which an address in Markdown may not
    (r"(?:(\]\(data:[^,()\s]*?;base64,)|\G(?!\A))([^\s()]*+)\s++", "$1$2"),
]

_STRUCTURE = [
    (r"(?i)<h([1-6])(?:\s[^<>]*+)?+>\s*+", f"\n\n{_HEADING}$1 "),
    (r"(?i)<blockquote(?:\s[^<>]*+)?+>\s*+", f"\n\n{_QUOTE} "),
    (rf"(?i)</?+(?:{_BLOCKS}|blockquote)(?:\s[^<>]*+)?+/?+>", "\n\n"),
    (r"(?i)</li\s*+>", ""),
    (r"<[a-zA-Z/!?][^<>]*+>", ""),
]

# Without these a cell is its text.
_IN_CELLS = rf"[<|\n{_ROW}{_NEXT_CELL}{_ROW_END}{_RULE}{_DASHES}]"

_EDGES = [(_LIST, "\n\n"), (_LIST_END, "\n\n"), (_ITEM, ""), (_PAGE, f"\n\n{_PAGE}\n\n")]

# What would begin a heading, a list or a quotation although the text only holds the character.
_ESCAPED = [(r"(?m)^([ \t]*+)(#{1,6}+[ \t]|[-+][ \t]|>)", r"$1\\$2")]

_MARKS = [
    (_BULLET, "- "),
    (_QUOTE, ">"),
    (_CELL_BREAK, "<br>"),
    (_ROW, "| "),
    (_NEXT_CELL, " | "),
    (_ROW_END, " |"),
    (_RULE, "|"),
    (_DASHES, " --- |"),
    (_BAR, "\\|"),
    (_KEPT_LINE, "\n"),
    (_KEPT_SPACE, " "),
    (_KEPT_TAB, "\t"),
    (_FENCE, "```"),
]

_SPACING = [
    (r"[ \t]*+\n[ \t]*+(?:\n[ \t]*+)++", "\n\n"),
    (r"[ \t]*+\n[ \t]*+", "\n"),
]


def _rewrite(text: Column, rules: list[tuple[str, str]]) -> Column:
    return reduce(lambda t, rule: F.regexp_replace(t, rule[0], rule[1]), rules, text)


def _replaced(text: Column, pairs: list[tuple[str, str]]) -> Column:
    return reduce(lambda t, pair: F.replace(t, F.lit(pair[0]), F.lit(pair[1])), pairs, text)


def _with_marks(text: Column) -> Column:
    """Marks become Markdown. Text is split at them, which is quicker than to look for each."""

    def heading(value: Column, i: Column) -> Column:
        level = F.concat(F.repeat(F.lit("#"), F.substring(value, 1, 1).cast("int")), F.substring(value, 2, _ALL))
        other = F.when(i == 0, value).otherwise(F.concat(F.lit(_HEADING), value))
        return F.when((i > 0) & value.rlike(r"\A[1-6] "), level).otherwise(other)

    text = F.array_join(F.transform(F.split(text, _HEADING), heading), "")
    return reduce(lambda t, mark: F.array_join(F.split(t, mark[0]), mark[1]), _MARKS, text)


def _with_page_marks(text: Column) -> Column:
    """What begins a page is marked; a form feed would be lost as white space."""
    styled = F.when(F.contains(text, F.lit("reak-before")), F.regexp_replace(text, _PAGE_STARTS, f"{_PAGE}<"))
    return F.replace(F.coalesce(styled, text), F.lit("\f"), F.lit(_PAGE))


def _runs(text: Column, odd: Column) -> Column:
    """A text in parts: every second one is a run of words, or empty for a ``_RUN`` of the text.
    Only ``odd`` ones may hold a "<" that is not closed."""
    own = F.when(F.contains(text, F.lit(_RUN)), F.replace(text, F.lit(_RUN), F.lit(_RUN * 2))).otherwise(text)
    whole = (odd & text.rlike(f"<{_NOT_CLOSED}")) | (F.contains(text, F.lit("]")) & text.rlike(_DATA_IN_TEXT))
    return F.split(F.when(whole, own).otherwise(F.regexp_replace(own, _WORDS, f"$1{_RUN}$2{_RUN}")), _RUN)


def _numbered(parts: Column) -> Column:
    """The text of ``_runs`` with numbers for the runs."""

    def part(value: Column, i: Column) -> Column:
        return F.when((i % 2 == 1) & (value != ""), i.cast("string")).otherwise(value)

    return F.array_join(F.transform(parts, part), _RUN)


def _with_runs(text: Column, parts: Column) -> Column:
    """The text with the runs that its numbers stand for."""

    def part(value: Column, i: Column) -> Column:
        run = F.when(value == "", F.lit(_RUN)).otherwise(F.element_at(parts, value.cast("int") + 1))
        return F.when(i % 2 == 1, run).otherwise(value)

    return F.array_join(F.transform(F.split(text, _RUN), part), "")


def _elements(text: Column, name: str, change) -> Column:
    """``change`` applied to what is inside each element; what follows it stays.

    Text is split at the element's start tags and each part at its first end tag.
    """
    parts = F.split(text, rf"(?i)<{name}(?=[\s>])")

    def part(value: Column, i: Column) -> Column:
        def parted(ends: Column) -> Column:
            inside = F.regexp_replace(F.element_at(ends, 1), r"\A[^<>]*+>", "")
            rest = F.when(F.size(ends) > 1, F.element_at(ends, 2)).otherwise(F.lit(""))
            return F.concat(change(inside), rest)

        return F.when(i == 0, value).otherwise(let(F.split(value, rf"(?i)</{name}\s*+>", 2), parted))

    found = text.rlike(f"(?i)<{name}")
    return F.when(found, F.array_join(F.transform(parts, part), "")).otherwise(text)


def _preformatted(inside: Column) -> Column:
    """Text whose spaces and lines later steps leave alone, between fences."""
    plain = F.regexp_replace(F.regexp_replace(inside, r"<[a-zA-Z/!?][^<>]*+>", ""), r"\r\n?+", "\n")
    kept = F.translate(F.btrim(plain, F.lit("\n")), "\n \t", f"{_KEPT_LINE}{_KEPT_SPACE}{_KEPT_TAB}")
    fence = F.lit(f"\n\n{_FENCE}")
    return F.concat(fence, F.lit(_KEPT_LINE), kept, F.lit(_KEPT_LINE + _FENCE + "\n\n"))


def _inside_out(text: Column, names: str, change) -> Column:
    """``change`` applied to elements of the same names, those inside others first.

    In a pass text is split before start tags. A part that has an end tag is an element
    that holds no other, and what follows it; so is the last one. Others wait for a
    later pass; the last pass takes what is left as closed.
    """
    starts, end = rf"(?i)<(?:{names})[\s>]", rf"(?i)</(?:{names})\s*+>"

    def part(value: Column, closed: Column) -> Column:
        def parted(ends: Column) -> Column:
            opened = F.element_at(ends, 1)
            inside = F.regexp_replace(opened, rf"(?i)\A<(?:{names})[^<>]*+>?+", "")
            rest = F.when(F.size(ends) > 1, F.element_at(ends, 2)).otherwise(F.lit(""))
            return F.concat(change(opened, inside), rest)

        applies = value.rlike(rf"(?i)\A<(?:{names})[\s>]") & (closed | value.rlike(end))
        return F.when(applies, let(F.split(value, end, 2), parted)).otherwise(value)

    def once(found: Column, level: Column) -> Column:
        def joined(parts: Column) -> Column:
            earlier = F.transform(F.slice(parts, 1, F.size(parts) - 1), lambda v: part(v, level == DEPTH))
            return F.concat(F.array_join(earlier, ""), part(F.element_at(parts, -1), F.lit(True)))

        parts = F.split(found, rf"(?i)(?=<(?:{names})[\s>])")
        return F.when(found.rlike(starts), let(parts, joined)).otherwise(found)

    return F.aggregate(F.array(*[F.lit(n) for n in range(1, DEPTH + 1)]), text, once)


def _list(opened: Column, inside: Column) -> Column:
    """Items behind numbers or bullets; the lines of lists inside them are indented."""
    items = F.split(inside, r"(?i)<li(?:\s[^<>]*+)?+>\s*+")

    def listed(numbered: Column) -> Column:
        def item(value: Column, i: Column) -> Column:
            number = F.concat(i.cast("string"), F.lit(". "))
            mark = F.when(numbered, number).otherwise(F.lit(_BULLET))
            width = F.when(numbered, F.length(number)).otherwise(F.lit(2))

            def nested(text: Column) -> Column:
                # lists that follow one another go on; text behind a list is a line of the item
                text = F.regexp_replace(text, rf"{_LIST_END}\s*+(?:{_LIST}|\z)|{_LIST}", "")
                text = F.replace(text, F.lit(_LIST_END), F.lit(f"\n{_ITEM}"))
                indent = F.concat(F.lit(_ITEM), F.repeat(F.lit(_KEPT_SPACE), width))
                return F.replace(F.ltrim(text), F.lit(_ITEM), indent)

            def written(text: Column) -> Column:
                holds_lists = reduce(Column.__or__, [F.contains(text, F.lit(m)) for m in (_LIST, _LIST_END, _ITEM)])
                line = F.when(holds_lists, nested(text)).otherwise(F.ltrim(text))
                return F.concat(F.lit(f"\n{_ITEM}"), mark, line)

            text = F.regexp_replace(value, r"(?i)</li\s*+>\s*+|</?+p(?:\s[^<>]*+)?+>", " ")
            return F.when(i == 0, value).otherwise(let(text, written))

        return F.array_join(F.transform(items, item), "")

    numbered = F.substring(opened, 1, 3).rlike("(?i)<ol")
    return F.concat(F.lit(_LIST), let(numbered, listed), F.lit(_LIST_END))


def _table(opened: Column, inside: Column) -> Column:
    """Rows of cells; end tags may be missing, breaks, bars and the rows of a table in a
    cell are kept."""
    rows = F.split(inside, r"(?i)<tr(?=[\s>])")

    def marked(text: Column) -> Column:
        text = F.regexp_replace(text, r"(?i)</?+(?:p|div|li)(?:\s[^<>]*+)?+>", "\n")
        text = F.regexp_replace(text, rf"<[a-zA-Z/!?][^<>]*+>|[{_ROW_END}{_RULE}{_DASHES}]", "")
        text = F.translate(text, f"{_ROW}{_NEXT_CELL}|", f"\n {_BAR}")
        return F.regexp_replace(F.btrim(text, F.lit(" \n")), r" *+\n[ \n]*+", _CELL_BREAK)

    def cell(value: Column) -> Column:
        rest = F.regexp_replace(value, r"\A[^<>]*+>", "")
        inside = F.when(F.startswith(value, F.lit(">")), F.substring(value, 2, _ALL)).otherwise(rest)
        return let(inside, lambda t: F.when(t.rlike(_IN_CELLS), marked(t)).otherwise(F.btrim(t, F.lit(" "))))

    def behind_first(parts: Column) -> Column:
        return F.filter(parts, lambda _, i: i > 0)

    def row(value: Column) -> Column:
        return F.transform(behind_first(F.split(value, r"(?i)<t[hd](?=[\s>])")), cell)

    filled = F.filter(F.transform(behind_first(rows), row), lambda r: F.size(r) > 0)

    def line(r: Column, i: Column) -> Column:
        text = F.concat(F.lit(_ROW), F.array_join(r, _NEXT_CELL), F.lit(_ROW_END))
        rule = F.concat(F.lit(f"\n{_RULE}"), F.repeat(F.lit(_DASHES), F.size(r)))
        return F.when(i == 0, F.concat(text, rule)).otherwise(text)

    return F.concat(F.lit("\n\n"), F.array_join(F.transform(filled, line), "\n"), F.lit("\n\n"))


def _entities(text: Column) -> Column:
    """Named and numeric character references, each decoded once; a no-break space is a space."""
    common = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "nbsp": " ", "apos": "'"}
    names = {name: chr(code) for name, code in name2codepoint.items() if name not in common}
    # two literals: one for each name would take longer to plan than most texts to convert
    table = F.map_from_arrays(*[F.split(F.lit("\n".join(x)), "\n") for x in (names.keys(), names.values())])

    def numbered(code: Column) -> Column:
        sound = (code > 0) & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        decoded = F.decode(F.unhex(F.lpad(F.hex(F.when(sound, code)), 8, "0")), "UTF-32")
        return F.when(code == 160, F.lit(" ")).when(code == ord(_RUN), F.lit(_RUN * 2)).otherwise(decoded)

    def numeric(name: Column) -> Column:
        hexed = F.regexp_extract(name, r"\A#[xX]([0-9a-fA-F]+)\z", 1)
        digits = F.when(hexed != "", F.conv(hexed, 16, 10)).otherwise(F.regexp_extract(name, r"\A#([0-9]+)\z", 1))
        return let(F.nullif(digits, F.lit("")).cast("long"), numbered)

    def part(value: Column, i: Column) -> Column:
        name = F.regexp_extract(value, r"\A(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});", 1)
        plain = F.concat(F.lit("&"), value)

        def decoded(name: Column) -> Column:
            known = F.when(F.startswith(name, F.lit("#")), numeric(name)).otherwise(F.try_element_at(table, name))
            rest = F.substring(value, F.length(name) + 2, F.lit(_ALL))
            return F.when(name == "", plain).otherwise(F.coalesce(F.concat(known, rest), plain))

        done = F.when(i == 0, value)
        for known, char in common.items():
            begun = F.startswith(value, F.lit(f"{known};"))
            done = done.when(begun, F.concat(F.lit(char), F.substring(value, len(known) + 2, _ALL)))
        return done.otherwise(let(name, decoded))

    parts = F.transform(F.split(text, "&"), part)
    return F.when(F.contains(text, F.lit("&")), F.array_join(parts, "")).otherwise(text)


def with_html_markdown(df: DataFrame, html: Column, out: str, pages: str | None = None) -> DataFrame:
    """Add the Markdown of each row's HTML; null HTML gives null. With ``pages`` also the
    Markdown of each page, as an array.

    Each pattern is one pass over the text, and what most pages lack is looked for
    first. One projection per step that reads its input more than once: Spark then
    computes that input only once.
    """
    count = 0

    def step(change) -> None:
        nonlocal df, count
        df = df.withColumn(f"_{count + 1}", change(F.col(f"_{count}")))
        count += 1

    odd, runs = F.col("_odd"), F.col("_runs")
    df = df.withColumn("_0", html).withColumn("_odd", F.col("_0").rlike(f"(?i)<(?:{_TO_DROP}|{_NOT_CLOSED})"))
    step(lambda t: F.when(odd, _rewrite(t, [(p, "") for p in _DROPPED])).otherwise(t))
    df = df.withColumn("_runs", _runs(F.col(f"_{count}"), odd))
    step(lambda _: _numbered(runs))
    step(lambda t: _elements(t, "pre", _preformatted))
    step(lambda t: F.regexp_replace(_with_page_marks(t), r"\s+", " "))
    step(lambda t: _rewrite(t, _INLINE))
    step(lambda t: _rewrite(t, _LINKS))
    step(lambda t: F.when(t.rlike(r"(?i)<img\b"), _rewrite(t, _IMAGES)).otherwise(t))
    step(lambda t: _inside_out(t, "table", _table))
    step(lambda t: _inside_out(t, "ul|ol", _list))
    step(lambda t: _replaced(_rewrite(t, _STRUCTURE), _EDGES))
    step(lambda t: _entities(_rewrite(t, _SPACING)))
    step(lambda t: _with_marks(_rewrite(F.btrim(t, F.lit(" \n")), _ESCAPED)))
    df = df.withColumn("_last", _with_runs(F.col(f"_{count}"), runs))
    between = rf"\n*+{_PAGE}\n*+"
    whole = F.btrim(F.regexp_replace("_last", between, "\n\n"), F.lit("\n"))
    df = df.withColumn(out, F.when(F.contains("_last", F.lit(_PAGE)), whole).otherwise(F.col("_last")))
    if pages is not None:
        df = df.withColumn(pages, F.split("_last", between))
    return df.drop("_odd", "_runs", "_last", *[f"_{n}" for n in range(count + 1)])
