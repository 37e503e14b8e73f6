"""Page texts of a form to unit records: a line automaton over whole documents.

Every line is looked at once.  Its words may mark the start of a unit's card or of one of the card's regions (names,
seats, leavers, dropouts, or the end of these); the state of a line is the last mark at or before it, so that headings
may be split, numbers may follow on the same line, the next one, or each on its own, and a card may go on over pages.
Spark brings a document's pages together in their order; the automaton runs over them as they come and holds one page,
the few lines that it looks ahead and the open region's first lines, so no document is put together in one row.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veritab.sources.files import few_at_once

# The form's labels, by which cards and regions begin and end.
FIELD, UNIT, COURSE = "分野", "学科名", "課程名"
SEATS, LEAVERS, DROPOUTS = ("生徒総定", "定員数"), ("卒業者数",), ("中途退学", "中退率")
ENDS = ("授業計画作成と公表", "成績評価の基準", "卒業・進級", "学修支援等", "カリキュラム")
# Words that stand where names do, and what a heading's own lines say.
LABELS = "専門士|学科名|分野|課程名|昼夜"
FIELDS = ("文化・教養", "教育・社会福祉", "服飾・家政", "商業実務", "社会福祉", "工業", "農業", "医療", "衛生", "教育", "商業", "服飾", "家政", "文化", "教養")
TEMPLATE = r"修業全課程|全課程の修了|開設している授業|授業時数|総単位数|単位時間|\d+\s*(単位|時間)"
NOTES = "直近|自営業|状況を記載"
UNIT_SUFFIX = "(学科|学部|学院|専攻|コース|科)$"
#: Lines of a region that are looked at, and rows in which a split heading's parts stand.
REACH = 25
HEADING = 8
#: Pictures, headings, emphasis and rules between rows; runs of white space and of bars between cells, other than one space;
#: a zero that a recogniser read as letters, alone on its line.
_BEGIN, _STOP = r"(?<![^\n\r\x85\u2028\u2029])", r"(?![^\n\r\x85\u2028\u2029])"
MARKUP = re.compile(rf"!\[[^\]\n]*\]\([^)\n]*\)|{_BEGIN}[ \t]*#{{1,6}}[ \t]+|\*{{1,3}}|{_BEGIN}[ \t]*\|[ \t:|-]+{_STOP}")
_GAP = r"[ |\t\x0B\f\r\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]"
GAPS = re.compile(rf"{_GAP}(?:{_GAP}+|(?<! ))")
ZERO = re.compile(r"^ ?[VYO]0 ?$", re.MULTILINE)
LINE_END = re.compile(r" ?\n[ \n]*")
#: Regions of a card that a row holds; a card of more takes several rows.
CARD_REGIONS = 64
#: Lines whose words are remembered, if they are short: forms repeat their labels.
KNOWN, SHORT = 10_000, 40


def _field(tail: str) -> str:
    return f"^({'|'.join(FIELDS)})(関係)?{tail}"


def cleaned_lines(text: str) -> list[str]:
    """The lines that are not empty of a page's text: compatibility forms folded, marks of markup that recognisers put in
    dropped, cells parted by spaces.  Pages of accounts that tell no enrolment have none."""
    text = unicodedata.normalize("NFKC", text)
    if ("財務" in text or "経営情報の公表" in text) and "生徒実員" not in text:
        return []
    if "|" in text or "#" in text or "*" in text or "![" in text:
        text = MARKUP.sub("", text)
    text = GAPS.sub(" ", text)
    if "V0" in text or "Y0" in text or "O0" in text:
        text = ZERO.sub("0人", text)
    lines = LINE_END.split(text) if " \n" in text or "\n " in text else text.split("\n")
    return [t for t in lines if t]


#: A line's words that count, by bits: of marks, and of what is near them.
WORDS = ((FIELD,), (UNIT,), (COURSE,), SEATS, LEAVERS, DROPOUTS, ENDS, ("進学", "就職"), ("修業",), ("年",), ("昼", "夜"), ("昼夜",))
IS_FIELD, IS_UNIT, IS_COURSE, IS_SEATS, IS_LEAVERS, IS_DROPOUTS, IS_END, LEAVES, TERM, YEAR, HALF, HALVES = (1 << i for i in range(len(WORDS)))
ANY_WORD = re.compile("|".join(w for group in WORDS for w in group))
YEARS, SHIFT = re.compile(r"(\d+)\s*年", re.ASCII), re.compile(r"(?:^|\s)(昼|夜)(?=\s|$)", re.ASCII)
#: Marks whose regions tell something, in the order of a card's columns.
TOLD = ("names", "seats", "leavers", "dropouts")


def words_of(line: str) -> int:
    if not ANY_WORD.search(line):
        return 0
    return sum(1 << i for i, group in enumerate(WORDS) if any(w in line for w in group))


words_of_short = lru_cache(KNOWN)(words_of)


class LineAutomaton:
    """The cards of one document, whose lines are fed in their order.

    A card begins where field and unit are named in one line, or where the field stands alone and unit and course are
    named in the next lines.  Leavers are only told where the heading's other words are near.
    """

    def __init__(self):
        #: lines with their words that wait for those after them, and the words of the two before
        self.waiting: list[tuple[str, int]] = []
        self.before = self.before_last = 0
        self.row = self.section = self.start = 0
        #: the first lines of the open region, and the open card's row
        self.lines: list[str] = []
        self.card: list | None = None

    def feed(self, lines: list[str], last: bool = False) -> list[tuple]:
        """Rows (section, row of its begin, regions by TOLD, duration, shift) of the cards that end before the last line
        that can be told; with last, of all."""
        waiting, out = self.waiting, []
        waiting += [(t, words_of_short(t) if len(t) <= SHORT else words_of(t)) for t in lines]
        ready = len(waiting) if last else max(0, len(waiting) - HEADING)
        for i in range(ready):
            t, words = waiting[i]
            self.row += 1
            if words:
                mark = self.mark(i, t, words)
                if mark:
                    self.begin(mark, out)
                if self.card:
                    if self.card[3] is None and words & YEAR and (words & (TERM | HALF) or (self.before | self.before_last) & TERM) and (found := YEARS.search(t)):
                        self.card[3] = float(found[1])
                    if self.card[4] is None and words & HALF and not words & HALVES and (found := SHIFT.search(t)):
                        self.card[4] = found[1]
            if self.row - self.start < REACH:
                self.lines.append(t)
            self.before_last, self.before = self.before, words
        del waiting[:ready]
        if last and self.card:
            out.append(tuple(self.card))
        return out

    def mark(self, i: int, t: str, words: int) -> str | None:
        """What begins at the waiting line i; a card's first line is "card ", or "card names" where it names the unit."""
        waiting = self.waiting
        if words & IS_UNIT:
            return "card names" if words & IS_FIELD else "names"
        if words & IS_FIELD and len(t) <= 5:
            next_words = [w for _, w in waiting[i + 1 : i + 1 + HEADING]]
            if any(w & IS_UNIT for w in next_words) and any(w & IS_COURSE for w in next_words):
                return "card "
        if words & IS_SEATS:
            return "seats"
        if words & IS_LEAVERS and any(w & LEAVES for _, w in waiting[i : i + 4]):
            return "leavers"
        return "dropouts" if words & IS_DROPOUTS else "end" if words & IS_END else None

    def begin(self, mark: str, out: list[tuple]) -> None:
        """Open a region, in a card of its own if its mark says so."""
        self.start, self.lines = self.row, []
        card, _, kind = mark.rpartition(" ")
        if card:
            self.section += 1
        if card or self.card and sum(map(len, self.card[2])) >= CARD_REGIONS:
            if self.card:
                out.append(tuple(self.card))
            self.card = [self.section, self.row, tuple([] for _ in TOLD), None, None]
        if self.card and kind in TOLD:
            self.card[2][TOLD.index(kind)].append(self.lines)


def cards(pages: DataFrame) -> DataFrame:
    """doc_id, section, start, the lines of each of the names, seats, leavers and dropouts, duration and shift of the cards
    of (doc_id, page, text): of each region its first REACH lines.  A null text has no lines; a card of very many regions
    takes several rows, by start."""
    kind = pages.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, automaton, ids = None, None, None

        def out(owners: list, found: list[tuple]) -> pa.RecordBatch:
            section, start, regions, duration, shift = zip(*found, strict=True)
            texts = pa.list_(pa.list_(pa.string()))
            told = [pa.array([r[i] for r in regions], texts) for i in range(len(TOLD))]
            columns = [pa.array(owners, ids), pa.array(section, pa.int64()), pa.array(start, pa.int64()), *told, pa.array(duration, pa.float64()), pa.array(shift, pa.string())]
            return pa.RecordBatch.from_arrays(columns, ["doc_id", "section", "start", *TOLD, "duration", "shift"])

        for batch in batches:
            ids = batch.schema.field("doc_id").type
            owners, found = [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if automaton is None or doc_id != of:
                    if automaton:
                        found += automaton.feed([], last=True)
                        owners += [of] * (len(found) - len(owners))
                    of, automaton = doc_id, LineAutomaton()
                if text:
                    found += automaton.feed(cleaned_lines(text))
                    owners += [of] * (len(found) - len(owners))
            if found:
                yield out(owners, found)
        if automaton and (found := automaton.feed([], last=True)):
            yield out([of] * len(found), found)

    together = pages.select("doc_id", F.col("page").cast("long").alias("page"), "text").repartition("doc_id").sortWithinPartitions("doc_id", "page")
    told = ", ".join(f"{name} array<array<string>>" for name in TOLD)
    return few_at_once(together).select("doc_id", "text").mapInArrow(work, f"doc_id {kind}, section long, start long, {told}, duration double, shift string")


def numbers_in(text: Column, pattern: str = r"(\d[\d,]*)") -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(pattern), 1), lambda x: F.replace(x, F.lit(","), F.lit("")).try_cast("long"))


def name_cells(lines: Column) -> Column:
    """What may be a course or a name in the lines after the heading.  A line with a course and more is a row of cells:
    the course, and the words up to a mark or a number; any other line is one cell, less the field that it begins with."""
    useful = F.filter(lines, lambda x: ~x.rlike(LABELS))

    def cells(x: Column) -> Column:
        rest = F.regexp_replace(F.regexp_extract(x, r"課程\s+(.*)$", 1), r"\s*(\s[〇○◯-]|\s\d).*$|[〇○◯]", "")
        alone = F.regexp_replace(F.regexp_replace(x, _field(r"\s+"), ""), r"[〇○◯\s]", "")
        return F.when(x.rlike(r"課程\s+\S"), F.array(F.regexp_extract(x, r"(\S*課程)", 1), F.regexp_replace(rest, r"\s", ""))).otherwise(F.array(alone))

    no_name = lambda c: (F.length(c) < 2) | c.rlike(_field("$")) | c.rlike(r"^修業(年限)?$|^年限$|^\d+年?$") | c.rlike(TEMPLATE)
    return F.filter(F.flatten(F.transform(useful, cells)), lambda c: ~no_name(c))


def unit_records(pages: DataFrame) -> DataFrame:
    """ARR-02, SRC-12, SRC-13, FLT-11: one row for each card of (doc_id, page, text) that tells a name and an enrolment.

    Of the seats, leavers and dropouts the first region counts that tells enough numbers.  A field that was read into the
    name is dropped where a name remains; a course and a name that stand in each other's place are put right.
    is_breakdown marks cards that only break a course down: they name a course and their seats are part of others.
    Documents without cards give no row; an empty table gives none.
    """
    # leavers' own notes, and headings of dropouts, tell no numbers; leavers end at the first line of percentages
    joined = lambda lines: F.array_join(lines, "\n")
    leavers = F.transform("leavers", lambda r: F.regexp_replace(joined(F.filter(r, lambda x: ~x.rlike(NOTES))), r"(?s)\n\(?\s*\d+(\.\d+)?\s*%.*$", ""))
    dropouts = F.transform("dropouts", lambda r: joined(F.filter(F.slice(r, 1, 6), lambda x: ~x.rlike("年度当初|途中") | x.rlike(r"\d\s*人"))))
    texts = {"seats": F.transform("seats", joined), "leavers": leavers, "dropouts": dropouts}
    # numbers in brackets, also in such as end on a later line, are parts of others
    bare = lambda of: F.transform(of, lambda x: F.regexp_replace(x, r"\([^)]*\)", " "))
    people = lambda x: numbers_in(x, r"(\d[\d,]*)\s*人")
    plain = lambda x: numbers_in(F.regexp_replace(x, r"\d+(\.\d+)?\s*%", " "))
    read = {m: F.transform(bare(c), lambda x: F.struct(people(x).alias("people"), plain(x).alias("plain"), F.regexp_count(x, F.lit("人")).alias("places"))) for m, c in texts.items()}
    # numbers of persons if there are three, else all but percentages
    three = lambda r: F.when(F.size(r["people"]) >= 3, r["people"]).when(F.size(r["plain"]) >= 3, r["plain"])
    # four places for numbers of which some are blank: the first is of leavers, the next of those employed
    two = lambda r: F.array(F.get(r["people"], F.lit(0)), F.lit(None).cast("long"), F.get(r["people"], F.lit(1)))
    blanks = lambda r: F.when(F.size(r["people"]).between(1, 2) & (r["places"] >= 4), two(r)).otherwise(three(r))
    first_of = lambda c, enough: F.get(F.filter(c, enough), F.lit(0))
    is_told = lambda n: n.isNotNull()
    rates = F.transform(texts["dropouts"], lambda x: F.regexp_extract(x, r"(\d+(?:\.\d+)?)\s*%", 1).try_cast("double"))
    told = cards(pages).select(
        "doc_id",
        "section",
        "start",
        first_of(F.transform("names", lambda r: name_cells(F.slice(r, 2, 11))), lambda c: F.size(c) > 0).alias("cells"),
        first_of(F.transform(read["seats"], three), is_told).alias("seats"),
        first_of(F.transform(read["leavers"], blanks), is_told).alias("leavers"),
        first_of(F.transform(read["dropouts"], lambda r: F.when(F.size(r["plain"]) >= 2, r["plain"])), is_told).alias("dropouts"),
        first_of(rates, is_told).alias("dropout_rate"),
        F.col("duration").alias("duration_years"),
        "shift",
        F.exists("seats", lambda r: F.exists(F.slice(r, 1, 4), lambda x: x.contains("内数"))).alias("part_of"),
    )
    # a document's cards meet once, those of many rows as one
    first = lambda c: F.min(F.when(F.col(c).isNotNull(), F.struct("start", c)))[c].alias(c)
    values = ("cells", "seats", "leavers", "dropouts", "dropout_rate", "duration_years", "shift")
    card = told.repartition("doc_id").groupBy("doc_id", "section").agg(*map(first, values), F.bool_or("part_of").alias("part_of"))
    is_course = lambda c: c.contains("専門課程")
    others = F.filter("cells", lambda c: ~is_course(c))
    named = card.withColumns({"name": F.get(others, F.lit(0)), "course_name": F.coalesce(F.get(F.filter("cells", is_course), F.lit(0)), F.get(others, F.lit(1)))})
    bare = F.regexp_replace("name", _field(""), "")
    name = F.when((F.length(bare) >= 2) & bare.rlike(UNIT_SUFFIX), bare).otherwise(F.col("name"))
    named = named.withColumn("name", name)
    swapped = F.col("name").rlike("(専門|本科)$") & ~F.col("name").rlike(UNIT_SUFFIX) & F.coalesce(F.col("course_name").rlike(UNIT_SUFFIX), F.lit(False))
    named = named.select("*", swapped.alias("swapped"))
    place = {"seats": ("capacity", "enrollment", "intl_students"), "leavers": ("graduates", "advanced", "employed", "other"), "dropouts": ("prev_enrollment", "dropouts")}
    measures = [F.get(c, F.lit(i)).alias(m) for c, names in place.items() for i, m in enumerate(names)]
    out = named.select(
        "doc_id", F.row_number().over(Window.partitionBy("doc_id").orderBy("section")).alias("section"),
        F.when(F.col("swapped"), F.col("course_name")).otherwise(F.col("name")).alias("name"),
        F.when(F.col("swapped"), F.concat("name", F.lit("課程"))).otherwise(F.col("course_name")).alias("course_name"),
        "duration_years", "shift", *measures, "dropout_rate", "part_of",
    )
    full = out.filter(F.col("name").isNotNull() & F.col("enrollment").isNotNull())
    return full.withColumn("is_breakdown", F.col("name").contains("コース") & F.coalesce("part_of", F.lit(False))).drop("part_of")
