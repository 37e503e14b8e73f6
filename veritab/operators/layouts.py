"""Lists of institutions in layouts that are not known beforehand.

What a column of a table holds is an assignment of columns to roles, solved for each table: a column's header speaks for
a role, and so does the share of its cells that look like it.  Each role goes to one column at most, so that of two
columns of addresses the one that fits the owner better is the owner's.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veritab.functions.text import squeezed
from veritab.functions.urls import first_url

# What headers say of a role; the longer of two that stand in a header counts.
HEADERS = {
    "number": "^(no\\.?|番号|項番)$", "name": "学校名|大学等の名称|機関名|名称", "address": "所在地|住所", "owner": "設置者名|設置者の名称|設置者|法人名",
    "owner_address": "設置者の?(主たる)?(事務所の)?(所在地|住所)|主たる事務所の所在地", "code": "コード", "date": "確認年月日|確認日|年月日", "url": "url|ホームページ|公表先|hp", "remark": "備考|摘要",
}
# Words of institutions' names, bare kinds of institutions, and words that no name holds.
INSTITUTIONS = "大学|専門学校|大学校|学院|カレッジ"
KINDS = "^[(（]?(国立|公立|県立|市立|私立)?(大学|短期大学|専門学校|専修学校|高等専門学校|大学校)([(（]?(国立|公立|県立|市立|私立)[)）]?)?[)）]?$"
NO_NAMES = "確認大学等|学校名|名称|所在地|設置者|修学支援|支援制度|奨学資金|奨学金|対象機関|確認の取消|確認取消|公表|資料|制度|支援課|大学関係|問い合わせ|一覧"
OWNERS = "^(学校法人|公益財団法人|一般財団法人|社会福祉法人|医療法人|独立行政法人|国立大学法人|株式会社|有限会社)|(法人|株式会社|組合)$"
PLACES = r"^(北海道|東京都|(?:京都|大阪)府|.{2,3}県)|[市区町村郡].*\d"
OUTSIDE = r"[＜<(（]外部(リンク|サイト(へリンク)?)[)）>＞]|​"
ROLES = tuple(HEADERS)
#: What a header's word weighs, against all cells of a column looking like a role.
HEADER_WEIGHT, CELL_WEIGHT = 3.0, 2.0
#: Of equal evidence: roles in this order stand in this order in tables.
ORDER_WEIGHT = 0.01


def looks_like_institution(key: Column) -> Column:
    """Whether a cell without white space may be an institution's name."""
    return (F.length(key) >= 4) & ~key.rlike(r"^\d+$") & ~key.rlike(KINDS) & ~key.rlike(NO_NAMES) & key.rlike(INSTITUTIONS)


def looks(key: Column, href: Column) -> dict[str, Column]:
    """Of each role whether a cell looks like it; of remarks nothing can be said."""
    return {
        "number": key.rlike(r"^\d{1,4}$"), "name": looks_like_institution(key) & ~key.rlike(OWNERS), "address": key.rlike(PLACES), "owner": key.rlike(OWNERS), "owner_address": key.rlike(PLACES),
        "code": key.rlike(r"^[A-Z]?\d{5,13}$"), "date": key.rlike(r"^(令和|平成|[RH]|20\d\d)[元\d.年/-]*\d+[.月/-]"), "url": key.rlike("^https?://") | (href.isNotNull() & ~looks_like_institution(key)), "remark": F.lit(False),
    }


def assigned(score: np.ndarray) -> list[int]:
    """Of each row the column that it gets, -1 for none, so that the sum of the scores is largest; scores of 0 or less are
    not taken.  Shortest augmenting paths over the rows, with prices of the columns."""
    rows, columns = score.shape
    # every row may take a column of its own that is worth nothing
    cost = -np.concatenate([np.maximum(score, 0), np.zeros((rows, rows))], 1)
    wide = columns + rows
    price, gain = np.zeros(wide + 1), np.zeros(rows)
    holder = np.full(wide + 1, -1)
    for row in range(rows):
        holder[wide] = row
        at, least, before, done = wide, np.full(wide, np.inf), np.full(wide, wide), np.zeros(wide + 1, bool)
        while holder[at] >= 0:
            done[at] = True
            r = holder[at]
            reduced = cost[r] - gain[r] - price[:wide]
            better = ~done[:wide] & (reduced < least)
            least[better], before[better] = reduced[better], at
            following = int(np.argmin(np.where(done[:wide], np.inf, least)))
            step = least[following]
            for j in np.flatnonzero(done):
                gain[holder[j]] += step
                price[j] -= step
            least[~done[:wide]] -= step
            at = following
        while at != wide:
            holder[at] = holder[before[at]]
            at = before[at]
    out = [-1] * rows
    for j in range(columns):
        if holder[j] >= 0 and score[holder[j], j] > 0:
            out[holder[j]] = j
    return out


def with_headers(cells: DataFrame) -> DataFrame:
    """cells with key, the text without white space and notes of outside links, and in_header, which holds for all cells of
    a row that is marked as a header or reads like one."""
    key = F.regexp_replace(squeezed(F.col("text")), OUTSIDE, "")
    row = Window.partitionBy("page_id", "tab", "row")
    keyed = cells.withColumn("key", key)
    any_ = lambda c: F.coalesce(F.bool_or(c).over(row), F.lit(False))
    says = lambda w: any_(F.col("key").contains(w))
    whole = F.lower("key").rlike("^(" + "|".join(f"(?:{h})" for h in HEADERS.values()) + ")$")
    # a header may also be told by two cells or more that say nothing else
    several = F.coalesce(F.count_if(whole).over(row) >= 2, F.lit(False))
    reads_like = any_(F.col("key").rlike("確認大学等|^学校名$")) | (says("名称") & says("所在地") & says("設置者")) | several
    return keyed.withColumn("in_header", any_(F.col("is_header")) | reads_like)


def column_roles(cells: DataFrame) -> DataFrame:
    """(page_id, tab, col, role) of cells with headers, for the columns that have a role."""
    k, h = F.col("key"), F.col("href")
    filled = ~F.col("in_header") & ((k != "") | h.isNotNull())
    evidence = []
    for role, like in looks(k, h).items():
        said = F.max(F.when(F.col("in_header"), F.length(F.regexp_extract(F.lower("key"), f"({HEADERS[role]})", 1)))).alias(f"{role}_said")
        evidence += [said, F.avg(F.when(filled, like.cast("double"))).alias(f"{role}_like")]
    columns = cells.groupBy("page_id", "tab", "col").agg(*evidence, F.count_if(filled).alias("filled"))
    struct = F.struct("col", *[F.coalesce(f"{r}_said", F.lit(0)).cast("int").alias(f"{r}_said") for r in ROLES], *[F.coalesce(f"{r}_like", F.lit(0.0)).alias(f"{r}_like") for r in ROLES])
    # a column of no cells has nothing to give
    tables = columns.filter("filled > 0").groupBy("page_id", "tab").agg(F.array_sort(F.collect_list(struct)).alias("columns"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place, col, role = [], [], []
            for i, table in enumerate(batch.column(2).to_pylist()):
                said = np.array([[c[f"{r}_said"] for c in table] for r in ROLES], float)
                like = np.array([[c[f"{r}_like"] for c in table] for r in ROLES])
                # of a header's words the longest counts
                speaks = (said > 0) & (said == said.max(0))
                order = ORDER_WEIGHT * np.outer(np.arange(len(ROLES)), np.arange(len(table))) / max(1, len(ROLES) * len(table))
                score = HEADER_WEIGHT * speaks + CELL_WEIGHT * like
                found = assigned(np.where(score > 0, score + order, 0))
                for r, j in enumerate(found):
                    if j >= 0:
                        place.append(i)
                        col.append(table[j]["col"])
                        role.append(ROLES[r])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(place, pa.int64())), batch.column(1).take(pa.array(place, pa.int64())), pa.array(col, pa.int32()), pa.array(role, pa.string())], ["page_id", "tab", "col", "role"]
            )

    kind = {f.name: f.dataType.simpleString() for f in cells.schema}
    return tables.mapInArrow(work, f"page_id {kind['page_id']}, tab {kind['tab']}, col int, role string")


def listed_institutions(cells: DataFrame) -> DataFrame:
    """SRC-23: (page_id, tab, row, name, address, owner, owner_address, code, date, url, remark) of table cells (page_id, tab,
    row, col, text, href, is_header): the rows whose name looks like an institution's.

    The address is that of the url's column, else one in the remark, else the link on the name, else one in a row of its
    own below.  Roles without a column are null; a table without a column of names gives no row, an empty table none.
    """
    headed = with_headers(cells)
    roles = column_roles(headed)
    # roles grow with the tables, so they are not broadcast
    body = headed.filter(~F.col("in_header")).join(roles.hint("merge"), ["page_id", "tab", "col"], "left")
    of = lambda role: F.max(F.when((F.col("role") == role) & (F.col("key") != ""), F.col("key")))
    link = lambda role: F.max(F.when(F.col("role") == role, F.coalesce(F.col("href"), first_url(F.col("text")))))
    texts = [of(r).alias(r) for r in ROLES if r not in ("number", "url")]
    any_url = F.max(F.coalesce(F.col("href"), first_url(F.col("text"))))
    rows = body.groupBy("page_id", "tab", "row").agg(*texts, F.coalesce(link("url"), link("remark"), link("name")).alias("url"), any_url.alias("any_url"))
    named = F.coalesce(looks_like_institution(F.col("name")), F.lit(False))
    # a row of its own below is the next one, which rows look up without meeting their table again
    following = Window.partitionBy("page_id", "tab").orderBy("row")
    is_below = (F.lead("row").over(following) == F.col("row") + 1) & ~F.lead(named).over(following)
    listed = rows.select("*", named.alias("named"), F.when(is_below, F.lead("any_url").over(following)).alias("below")).filter("named")
    return listed.select("page_id", "tab", "row", "name", "address", "owner", "owner_address", "code", "date", F.coalesce("url", "below").alias("url"), "remark")
