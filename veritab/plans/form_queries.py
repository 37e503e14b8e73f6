"""Queries of forms in several layouts: each unit's values follow from the key, and so does the layout they are told in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritab.operators import layouts, sections
from veritab.plans.registry import Load, query
from veritab.sources import markup

# Names of units, in the form that they are read in, and of courses.
UNIT_NAMES = ("情報処理科", "CG映像学科", "看護学科", "国家資格学科(応用専攻)", "Webデザイン科", "デジタルコース", "放送技術科")
UNIT_COURSES = ("工業専門課程", "デジタル専門課程", "文化・教養専門課程")
LAYOUTS = 6
#: Of each measure: least value, how many there are, and the step by which the unit's number moves it.
UNIT_MEASURES = {
    "capacity": (20, 380, 7), "enrollment": (5, 371, 11), "intl_students": (0, 9, 1), "graduates": (10, 150, 3), "advanced": (0, 7, 5),
    "employed": (3, 140, 13), "other": (0, 31, 2), "prev_enrollment": (8, 350, 17), "dropouts": (0, 40, 3),
}
WIDE = ("0123456789", "０１２３４５６７８９")


def _cases(n: str, values: tuple[str, ...]) -> str:
    return f"CASE {n} % {len(values)} " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values)) + " END"


def unit_values() -> dict[str, str]:
    """The values of unit number u, as SQL that both sides read."""
    numbers = {m: f"CAST({low} + (u * {step}) % {n} AS BIGINT)" for m, (low, n, step) in UNIT_MEASURES.items()}
    return {"name": _cases("u", UNIT_NAMES), "course_name": _cases("u", UNIT_COURSES), "duration_years": "CAST(1 + u % 4 AS DOUBLE)", "shift": "CASE WHEN u % 3 = 0 THEN '夜' ELSE '昼' END"} | numbers


def unit_card(layout: int) -> Column:
    """A unit's card as one of the layouts tells it."""
    col = lambda m: F.col(m).cast("string")
    people = lambda *ms: [x for m in ms for x in (col(m), "人 ")]
    years = F.concat(F.col("duration_years").cast("int").cast("string"), F.lit("年"))
    rate = F.concat((F.col("u") % 400 / 10).cast("decimal(5,1)").cast("string"), F.lit("%"))
    name, course, shift = F.col("name"), F.col("course_name"), F.col("shift")
    zero = F.when(F.col("intl_students") == 0, "V0").otherwise(F.concat(col("intl_students"), F.lit("人")))
    leavers = ("graduates", "advanced", "employed", "other")
    heading = "卒業者数、進学者数、就職者数（直近の年度の状況を記載）\n卒業者数 進学者数 就職者数 その他\n（自営業を含む。）\n"
    gone = "中途退学の現状\n年度当初在学者数 年度の途中における退学者の数 中退率\n"
    parts = {
        # a table read as text, with counts that are parts of others in brackets
        0: ["分野 課程名 学科名 専門士 高度専門士\n工業 ", course, " ", name, " 〇\n修業年限 昼夜 総授業時数\n", years, " ", shift, " 1700時間\n生徒総定員数 生徒実員 うち留学生数 専任教員数\n", col("capacity"), "人(116の内数) ", *people("enrollment", "intl_students"), "3人 4人\nカリキュラム（授業方法）\n", heading, *people(*leavers), "\n(100%) ( 6.6%) (90.8%) (2.6%)\n", gone, *people("prev_enrollment", "dropouts"), rate, "\n"],
        # each label and number on a line of its own, as recognisers give them; a zero misread
        1: ["分野\n課程名\n学科名\n専門士\n高度専門士\n文化・教養関係\n", course, "\n", name, "\n修業\n年限\n", years, "\n", shift, "\n生徒総定\n員数\n生徒実員\nうち留学生\n数\n", col("capacity"), "人\n", col("enrollment"), "人\n", zero, "\n3人\n授業計画作成と公表\n卒業者数\n進学者数\n就職者数\n", *[x for m in leavers for x in (col(m), "人\n")], "100%\n6.6%\n中途退学の現状\n年度当初在学者数\n年度の途中における退学者の数\n中退率\n", col("prev_enrollment"), "人\n", col("dropouts"), "人\n", rate, "\n"],
        # rows of a marked-up table
        2: ["| 分野 | 課程名 | 学科名 |\n|---|---|---|\n| 工業 | ", course, " | ", name, " |\n| 修業年限 | ", years, " | ", shift, " |\n| 生徒総定員 | ", col("capacity"), "人 | 生徒実員 | ", col("enrollment"), "人 | うち留学生数 | ", col("intl_students"), "人 |\n| 卒業者数 | 進学者数 | 就職者数 | その他 |\n| ", *people(*leavers), "|\n## 中途退学の現状\n| ", *people("prev_enrollment", "dropouts"), rate, " |\n"],
        # wide digits, numbers beside their shares, the field run into the name
        3: [F.translate(F.concat(F.lit("分野　課程名　学科名\n医療"), name, F.lit("\n"), course, F.lit("\n修業年限　"), years, F.lit("　"), shift, F.lit("\n生徒総定員数　生徒実員　うち留学生数\n"), col("capacity"), F.lit("　"), col("enrollment"), F.lit("　"), col("intl_students"), F.lit("\n卒業者数　進学者数　就職者数　その他\n"), *[F.concat(col(m), F.lit("(12.5%) ")) for m in leavers], F.lit("\n中途退学の現状\n"), col("prev_enrollment"), F.lit("人　"), col("dropouts"), F.lit("人　"), rate, F.lit("\n")), *WIDE)],
        # blanks among the leavers, so that only those who left and those employed are told
        4: ["分野 課程名 学科名\n", name, "\n", course, "\n修業年限\n", years, "\n", shift, "\n生徒総定員数 生徒実員 うち留学生数\n", *people("capacity", "enrollment", "intl_students"), "\n", heading, col("graduates"), "人 人 ", col("employed"), "人 人\n(100%)\n", gone, col("prev_enrollment"), " ", col("dropouts"), " ", rate, "\n"],
        # a bracket over two lines; what is part of others may be a course only
        5: ["分野 課程名 学科名\n商業実務 ", course, " ", name, " 〇\n修業年限 ", years, " ", shift, "\n生徒総定員数 生徒実員 うち留学生数\n", col("capacity"), "(116の\n内数)人 ", *people("enrollment", "intl_students"), "2人\n", heading, *people(*leavers), "\n100% 6.6%\n", gone, *people("prev_enrollment", "dropouts"), rate, "\n"],
    }
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts[layout]])


def unit_pages(orders: DataFrame) -> DataFrame:
    """(doc_id, page, text): a cover, two cards of which the second begins on one page and ends on the next, and a page of
    accounts that tells nothing of units."""
    # the table is one file; its keys are spread before texts are made of them
    keys = orders.select(F.col("o_orderkey").alias("doc_id")).repartition(32, "doc_id")
    of_unit = keys.select("doc_id", F.explode(F.array(F.lit(1), F.lit(2))).alias("s")).withColumn("u", F.col("doc_id") * 2 + F.col("s"))
    valued = of_unit.select("*", *[F.expr(x).alias(m) for m, x in unit_values().items()])
    card = None
    for layout in range(LAYOUTS):
        card = F.when(F.col("doc_id") % LAYOUTS == layout, unit_card(layout)) if card is None else card.when(F.col("doc_id") % LAYOUTS == layout, unit_card(layout))
    told = valued.select("doc_id", "s", card.alias("card"))
    cut = F.instr("card", "卒業者数") - 1
    texts = F.when(F.col("s") == 1, F.array(F.struct(F.lit(1).alias("page"), F.concat(F.lit("学校名 東京専門学校\n"), "card").alias("text")))).otherwise(
        F.array(
            F.struct(F.lit(2).alias("page"), F.substring(F.col("card"), F.lit(1), cut).alias("text")),
            F.struct(F.lit(3).alias("page"), F.substring(F.col("card"), cut + 1, F.length("card")).alias("text")),
            F.struct(F.lit(4).alias("page"), F.lit("財務諸表\n分野 学科名\n生徒総定員 1人 2人 3人").alias("text")),
        )
    )
    return told.select("doc_id", F.explode(texts).alias("p")).select("doc_id", "p.*")


_BLANK = "CASE WHEN o_orderkey % 6 = 4 THEN NULL ELSE {} END"
# a field that runs into a name stays where the rest does not end as a unit's name does
_TOLD = unit_values() | {"name": f"CASE WHEN o_orderkey % 6 = 3 AND u % {len(UNIT_NAMES)} = 3 THEN '医療' ELSE '' END || {unit_values()['name']}"}
_SHOWN = ", ".join(f"{_BLANK.format(x) if m in ('advanced', 'other') else x} AS {m}" for m, x in _TOLD.items())


@query("unit_sections", f"""SELECT o_orderkey AS doc_id, s::INT AS section, {_SHOWN}, ((u % 400) / 10)::DECIMAL(5,1)::DOUBLE AS dropout_rate, u % {len(UNIT_NAMES)} = 5 AND o_orderkey % 6 IN (0, 5) AS is_breakdown
FROM (SELECT o_orderkey, s, o_orderkey * 2 + s AS u FROM orders, unnest([1, 2]) AS x(s))""")
def unit_sections(t: Load) -> DataFrame:
    """ARR-02, SRC-12, SRC-13, FLT-11: page texts in six layouts to unit records."""
    return sections.unit_records(unit_pages(t("orders")))


# --- links of raw pages ------------------------------------------------------------------------------------------

#: Of each extractor a piece of markup that bears the page's id, and the text that its link has; signs inside quotes, nested
#: elements, comments and scripts stand beside it.
MARKUP = {
    "anchor": ('<!-- <a href="/no#.pdf">no</a> --><a class="x>y" href="/f/#.pdf?v=2">Form <b>#</b> &amp; more</a>', "/f/#.pdf?v=2", "Form # & more", "cache_busted"),
    "embed": ("<object data='/wp-content/#.pdf'>none</object>", "/wp-content/#.pdf", "none", "embed_wordpress"),
    "download_manager": ('<a data-downloadurl="/get?wpdmdl=#">Get #</a>', "/get?wpdmdl=#", "Get #", "wordpress_download_manager"),
    "meta_refresh": ("<title>Page #</title><META content='5; URL=/m/#.PDF' HTTP-EQUIV=refresh>", "/m/#.PDF", "Page #", "meta_refresh_direct"),
    "select_option": ("<select><option value=''>-<option value=/o/#.pdf>Year #</select>", "/o/#.pdf", "Year #", "select_option_direct"),
    "form_action": ('<form action="/s/#.pdf"><p>Get it<input type=submit value="Now #"></p></form>', "/s/#.pdf", "Get it Now #", "form_action_direct"),
    "data_attribute": ('<div data-file="/d/#%2Epdf"><div>Inner</div>Outer #</div>', "/d/#%2Epdf", "Inner Outer #", "data_attribute_direct"),
    "onclick": ("<button onclick=\"track('x'); open('/c/#.pdf')\">Open > #</button>", "/c/#.pdf", "Open > #", "onclick_direct"),
    "input_control": ('<script>var a = "<a href=\'/no#.pdf\'>";</script><input type="button" data-url="/i/#.pdf" aria-label="Load #">', "/i/#.pdf", "Load #", "input_control_direct"),
}
_ORIGIN = "regexp_extract(url, '^([^:]+://[^/?#]+)', 1)"
MARKUP_SQL = " UNION ALL ".join(
    f"""SELECT page_id, '{source}' AS source, {_ORIGIN} || replace('{address.replace("'", "''")}', '#', page_id::VARCHAR) AS href, replace('{text.replace("'", "''")}', '#', page_id::VARCHAR) AS text, '{pattern}' AS pattern FROM pages WHERE page_id % 9 <> {i}"""
    for i, (source, (_, address, text, pattern)) in enumerate(MARKUP.items())
)


@query("markup_links", MARKUP_SQL)
def markup_links(t: Load) -> DataFrame:
    """SRC-25: every page, with eight of nine kinds of links to documents in its body."""
    pieces = [F.when(F.col("page_id") % 9 != i, F.replace(F.lit(piece), F.lit("#"), F.col("page_id").cast("string"))).otherwise("") for i, (piece, *_) in enumerate(MARKUP.values())]
    html = F.concat(F.replace(F.coalesce("html", F.lit("")), F.lit("</body>"), F.lit("")), *pieces, F.lit("</body></html>"))
    return markup.markup_links(t("pages").select("page_id", "url", html.alias("html")), documents=True).select("page_id", "source", "href", "text", "pattern")


@query("markup_anchors", r"""WITH a AS (SELECT page_id, unnest(regexp_extract_all(regexp_replace(coalesce(html, ''), '(?s)<!--.*?-->|<script.*?</script>', '', 'g'), '(?is)<a\b[^>]*?href\s*=\s*["'']([^"'']*)["''][^>]*>(.*?)</a\s*>', 2)) AS text FROM pages),
p AS (SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(regexp_replace(text, '<[^>]+>', ' ', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&'), '\s+', ' ', 'g')) AS text FROM a)
SELECT page_id, count(*) AS links, md5(string_agg(text, chr(10) ORDER BY text)) AS digest FROM p GROUP BY 1""")
def markup_anchors(t: Load) -> DataFrame:
    """SRC-25: the anchors of all pages, one extractor of nine switched on."""
    found = markup.markup_links(t("pages"), ["anchor"])
    return found.groupBy("page_id").agg(F.count("*").alias("links"), F.md5(F.array_join(F.array_sort(F.collect_list("text")), "\n")).alias("digest"))


# --- lists of institutions ---------------------------------------------------------------------------------------

#: Ten layouts: of each column its header (null: the layout has none), and the role whose value its cells hold; "blank" is
#: an empty column, "url_below" a row of its own under the row.
LISTS: tuple[tuple[tuple[str | None, str], ...], ...] = (
    (("確認大学等の名称", "name"), ("所在地", "address"), ("設置者", "owner"), ("設置者の主たる事務所の所在地", "owner_address"), ("備考", "remark_url")),
    (("No.", "number"), ("学校名", "name"), ("住所", "address"), ("設置者名", "owner"), ("設置者住所", "owner_address"), ("備考", "remark")),
    (("学校名", "name_link"), ("設置者", "owner"), ("備考", "remark")),
    (("設置者名", "owner"), ("学校名", "name"), ("学校コード", "code"), ("ホームページ", "url")),
    ((None, "name"), (None, "address"), (None, "owner"), (None, "owner_address"), (None, "url")),
    (("名称", "name"), ("", "blank"), ("", "blank"), ("所在地", "address"), ("", "blank"), ("設置者の名称", "owner"), ("", "blank"), ("主たる事務所の所在地", "owner_address"), ("", "blank"), ("備考", "remark_url")),
    (("番号", "number"), ("機関名", "name"), ("確認年月日", "date"), ("URL", "url"), ("摘要", "remark")),
    (("学校名", "name"), ("所在地", "address"), ("設置者", "owner"), ("備考", "url_below")),
    ((None, "number"), (None, "code"), (None, "owner"), (None, "name"), (None, "date")),
    (("公表先", "url"), ("法人名", "owner"), ("住所", "address"), ("機関名", "name"), ("コード", "code"), ("備考", "remark")),
)
#: Rows of a list.
LIST_ROWS = 15
_LIST_VALUES = {
    "number": "CAST(k % 15 + 1 AS STRING)", "name": "concat('第', CAST(k AS STRING), CASE WHEN k % 4 = 0 THEN '専門学校' WHEN k % 4 = 1 THEN '短期大学' WHEN k % 4 = 2 THEN '工業大学校' ELSE '看護学院' END)",
    "address": "concat('東京都港区', CAST(k AS STRING), '-1')", "owner": "concat('学校法人', CAST(k % 500 AS STRING), '学園')", "owner_address": "concat('千葉県市川市', CAST(k % 500 AS STRING), '-2')",
    "code": "concat('H1', lpad(CAST(k AS STRING), 9, '0'))", "date": "concat('令和', CAST(k % 7 + 1 AS STRING), '年8月', CAST(k % 28 + 1 AS STRING), '日')", "url": "concat('https://e', CAST(k AS STRING), '.ac.jp/')",
    "remark": "CASE WHEN k % 3 = 0 THEN '名称変更' WHEN k % 3 = 1 THEN concat('統合', CAST(k AS STRING)) END",
}


def list_cells(customers: DataFrame) -> DataFrame:
    """(page_id, tab, row, col, text, href, is_header): fifteen customers to a list, whose layout its number tells."""
    k = F.col("c_custkey")
    valued = customers.select("c_custkey").repartition(16, "c_custkey").select(k.alias("k"), F.floor(k / LIST_ROWS).cast("long").alias("page_id"), (k % LIST_ROWS * 2 + 2).cast("int").alias("row")).select("*", *[F.expr(v).alias(r) for r, v in _LIST_VALUES.items()])
    none = F.lit(None).cast("string")

    def cell(col: int, role: str) -> tuple[Column, ...]:
        text = {"blank": F.lit(""), "remark_url": F.concat_ws(" ", "remark", "url"), "name_link": F.concat("name", F.lit("＜外部リンク＞")), "url_below": F.col("remark")}.get(role)
        # a space within names, as in print
        shown = F.regexp_replace("name", "^(第)", "$1 ") if role == "name" else F.col(role) if text is None else text
        return F.lit(col).alias("col"), shown.alias("text"), (F.col("url") if role == "name_link" else none).alias("href")

    # one expression for all layouts, so that the table is read and its texts are made once
    cells = None
    for n, layout in enumerate(LISTS):
        body = [F.struct("row", *cell(i, role), F.lit(False).alias("is_header")) for i, (_, role) in enumerate(layout)]
        if any(role == "url_below" for _, role in layout):
            body.append(F.struct((F.col("row") + 1).alias("row"), F.lit(0).alias("col"), F.col("url").alias("text"), none.alias("href"), F.lit(False).alias("is_header")))
        told = F.array(*body)
        if layout[0][0] is not None:
            first = [F.struct(F.lit(0).alias("row"), F.lit(i).alias("col"), F.lit(h).alias("text"), none.alias("href"), F.lit(n % 2 == 0).alias("is_header")) for i, (h, _) in enumerate(layout)]
            told = F.when(F.col("k") % LIST_ROWS == 0, F.array(*first, *body)).otherwise(told)
        is_layout = F.col("page_id") % len(LISTS) == n
        cells = F.when(is_layout, told) if cells is None else cells.when(is_layout, told)
    return valued.select("page_id", F.explode(cells).alias("cell")).select("page_id", "cell.*").withColumn("tab", F.lit(1))


def _list_sql() -> str:
    told = {"remark_url": ("remark", "url"), "name_link": ("name", "url"), "url_below": ("remark", "url")}
    held = [{r for _, role in layout for r in told.get(role, (role,))} for layout in LISTS]
    shown = []
    for role, value in _LIST_VALUES.items():
        if role != "number":
            at = ", ".join(str(n) for n, roles in enumerate(held) if role in roles)
            sql = value.replace("STRING", "VARCHAR")
            if role == "remark":
                joined = ", ".join(str(n) for n, layout in enumerate(LISTS) if any(r == "remark_url" for _, r in layout))
                sql = f"CASE WHEN c_custkey // {LIST_ROWS} % 10 IN ({joined}) THEN coalesce({sql}, '') || {_LIST_VALUES['url'].replace('STRING', 'VARCHAR')} ELSE {sql} END"
            shown.append(f"CASE WHEN c_custkey // {LIST_ROWS} % {len(LISTS)} IN ({at}) THEN {sql} END AS {role}")
    # a list's first customer bears the header, so lists without it, at the table's ends, have none
    return f"SELECT c_custkey // {LIST_ROWS} AS page_id, (c_custkey % {LIST_ROWS} * 2 + 2)::INT AS row, {', '.join(shown)} FROM (SELECT *, c_custkey AS k FROM customer)"


@query("listed_institutions", _list_sql())
def listed_institutions(t: Load) -> DataFrame:
    """SRC-23: lists in ten layouts, each row's roles by the assignment that its table's columns give."""
    return layouts.listed_institutions(list_cells(t("customer"))).drop("tab")
