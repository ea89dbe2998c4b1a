"""HTML: tables to rows and records to pages."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types
from pyspark.sql.functions import pandas_udf

from ..functions import mathtext as M
from ..functions import text as T

NAMES = ("table_no", "row", "col", "tag", "colspan", "rowspan", "text")
CELLS = types.ArrayType(types.StructType([types.StructField(n, types.StringType() if n in ("tag", "text") else types.IntegerType()) for n in NAMES]))
TABLE = r"(?is)(<table\b[^>]*>.*?</table>)"


class Tables(HTMLParser):
    """Cells of all tables of a text, nested tables on their own."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.cells: list[list] = []
        self.open: list[dict] = []
        self.count = 0

    @staticmethod
    def span(attrs, name: str) -> int:
        """Of one or two digits, at most 20; anything else is no span."""
        value = (dict(attrs).get(name) or "").strip()
        return min(max(int(value), 1), 20) if value.isdecimal() and len(value) <= 2 else 1

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.count += 1
            self.open.append({"no": self.count, "row": 0, "col": 0, "cell": None})
        elif self.open and tag == "tr":
            self.close_cell()
            self.open[-1].update(row=self.open[-1]["row"] + 1, col=0)
        elif self.open and tag in ("td", "th"):
            self.close_cell()
            t = self.open[-1]
            t["row"] = max(t["row"], 1)
            t["col"] += 1
            t["cell"] = [t["no"], t["row"], t["col"], tag, self.span(attrs, "colspan"), self.span(attrs, "rowspan"), ""]
        elif self.open and tag == "br" and self.open[-1]["cell"]:
            self.open[-1]["cell"][6] += " "

    def close_cell(self) -> None:
        cell = self.open[-1]["cell"]
        if cell:
            cell[6] = " ".join(cell[6].split())
            self.cells.append(cell)
            self.open[-1]["cell"] = None

    def handle_endtag(self, tag):
        if self.open and tag in ("td", "th", "tr", "table"):
            self.close_cell()
            if tag == "table":
                self.open.pop()

    def handle_data(self, data):
        if self.open and self.open[-1]["cell"]:
            self.open[-1]["cell"][6] += data


def table_cells(value: str | None) -> list[tuple]:
    """(table_no, row, col, tag, colspan, rowspan, text); rows of blank cells only are left out."""
    parser = Tables()
    parser.feed(value or "")
    parser.close()
    while parser.open:
        parser.handle_endtag("table")
    full = {(c[0], c[1]) for c in parser.cells if c[6]}
    return [tuple(c) for c in sorted(parser.cells) if (c[0], c[1]) in full]


@pandas_udf(CELLS)
def cells(values: pd.Series) -> pd.Series:
    return values.map(lambda v: [dict(zip(NAMES, c, strict=True)) for c in table_cells(v)])


def html_tables(df: DataFrame, keys, column: str) -> DataFrame:
    """A row a cell of the column's tables; texts without a table never reach Python."""
    return df.where(F.rlike(column, F.lit("(?i)<table"))).select(*keys, F.inline(cells(column)))


def elements(df: DataFrame, keys, column: str, tag: str) -> DataFrame:
    """(keys, index, text) of the elements of one tag that hold no other of their kind, markup removed."""
    found = F.regexp_extract_all(F.col(column), F.lit(rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}>"))
    rows = df.select(*keys, F.posexplode(found).alias("index", "raw"))
    return rows.select(*keys, "index", T.collapse(F.regexp_replace("raw", "<[^>]+>", "")).alias("text"))


# What the page format writes for blanks in text and in formulas, and the parts of a question's answer.
BLANK_HTML = '<span class="blank"></span>'
CHOICE_HTML = '<span class="choice-blank"><span class="choice-blank-space"></span></span>'
BLANK_TEX = r"\underline{\hspace{3em}}"
CHOICE_TEX = r"(\hspace{1.8em})"
#: (title, field, class of its text, folded, title of its figures, their role)
SECTIONS = (
    ("答案", "answer_latex", "answer-section", False, "答案配图", "answer_figure"),
    ("解析", "analysis_latex", "analysis-section", True, "解析配图", "analysis_figure"),
    ("评分标准", "rubric_latex", "rubric-section", True, "", ""),
)
CELL = types.StructType([types.StructField(n, types.StringType() if n in ("tag", "text") else types.IntegerType()) for n in ("line", "tag", "colspan", "rowspan", "text")])
TABLE_CELLS = types.ArrayType(types.ArrayType(CELL))


def _text_html(c: Column) -> Column:
    t = T.escape_html(F.replace(c, F.lit(r"\blankline{}"), F.lit("____")))
    t = F.regexp_replace(F.regexp_replace(t, r"(?U)[(（]\s*_{2,}\s*[)）]", CHOICE_HTML), "_{2,}", BLANK_HTML)
    for written, shown in (("&lt;blank&gt;", BLANK_HTML), ("&lt;choice_blank&gt;", CHOICE_HTML), ("\n", "<br>")):
        t = F.replace(t, F.lit(written), F.lit(shown))
    return t


def _math_html(c: Column) -> Column:
    for written, shown in ((r"\blankline{}", BLANK_TEX), ("<choice_blank>", CHOICE_TEX), ("<blank>", BLANK_TEX)):
        c = F.replace(c, F.lit(written), F.lit(shown))
    return T.escape_html(F.regexp_replace(c, "_{2,}", BLANK_TEX.replace("\\", "\\\\")))


def render_inline(c: Column) -> Column:
    """Text with formulas as HTML: escaped; blanks as spans in text and as TeX in formulas; lines of text as breaks."""
    return F.array_join(F.transform(M.segments(c), lambda s: F.when(s["is_math"], _math_html(s["segment"])).otherwise(_text_html(s["segment"]))), "")


def _each_table(tables: list[str]) -> list[list[dict]]:
    found = []
    for table in tables:
        cells = table_cells(table)
        lines = {at: i for i, at in enumerate(dict.fromkeys(c[:2] for c in cells))}
        found.append([{"line": lines[c[:2]], "tag": c[3], "colspan": c[4], "rowspan": c[5], "text": c[6]} for c in cells])
    return found


@pandas_udf(TABLE_CELLS)
def _tables_cells(values: pd.Series) -> pd.Series:
    return values.map(_each_table)


def _table_html(cells: Column) -> Column:
    """A table of its cells in order; no cells: empty."""

    def cell(c: Column, i: Column) -> Column:
        row = F.when(i == 0, F.lit("<tr>")).when(c["line"] != F.get(cells, i - 1)["line"], F.lit("</tr><tr>")).otherwise("")
        spans = (F.when(c[n] > 1, F.concat(F.lit(f' {n}="'), c[n].cast("string"), F.lit('"'))).otherwise("") for n in ("colspan", "rowspan"))
        return F.concat(row, F.lit("<"), c["tag"], *spans, F.lit(">"), render_inline(c["text"]), F.lit("</"), c["tag"], F.lit(">"))

    whole = F.concat(F.lit('<div class="table-wrap"><table class="html-table">'), F.array_join(F.transform(cells, cell), ""), F.lit("</tr></table></div>"))
    return F.when(F.size(cells) > 0, whole).otherwise("")


def with_tables(df: DataFrame, blocks: Column, name: str = "tables") -> DataFrame:
    """df with a map from each HTML table of an array of texts to the table as it is rendered; only tables reach Python."""
    found = F.array_distinct(F.flatten(F.transform(blocks, lambda b: F.regexp_extract_all(F.coalesce(b, F.lit("")), F.lit(TABLE), F.lit(0)))))
    cut = df.withColumn("_found", F.coalesce(found, F.array().cast("array<string>"))).withColumn("_cells", _tables_cells("_found"))
    return cut.withColumn(name, F.map_from_arrays("_found", F.transform("_cells", _table_html))).drop("_found", "_cells")


def render_block(c: Column, tables: Column) -> Column:
    """A block as HTML: paragraphs, and between them its tables by the map of ``with_tables``; a table without text goes."""
    c = F.coalesce(c, F.lit(""))
    found = F.regexp_extract_all(c, F.lit(TABLE), F.lit(0))

    def paragraph(t: Column) -> Column:
        return F.when(t != "", F.concat(F.lit('<p class="text-block">'), render_inline(t), F.lit("</p>"))).otherwise("")

    return F.array_join(F.transform(F.split(c, TABLE), lambda t, i: F.concat(paragraph(T.strip(t)), F.coalesce(F.try_element_at(tables, F.get(found, i)), F.lit("")))), "")


def _texts(blocks: Column) -> Column:
    """Blocks trimmed, blank ones left out."""
    return F.filter(F.transform(F.coalesce(blocks, F.array().cast("array<string>")), T.strip), lambda b: b != "")


def render_blocks(blocks: Column, tables: Column) -> Column:
    """Blocks as HTML; nothing to show: empty."""
    return F.array_join(F.transform(_texts(blocks), lambda b: render_block(b, tables)), "")


def render_asset(label: Column, sources: Column, kind: str = "figure") -> Column:
    """An image by the map from labels to paths; a label without one is named as missing."""
    src, alt = F.try_element_at(sources, label), T.escape_html(label)
    image = F.concat(F.lit(f'<img class="{kind}" src="'), T.escape_html(src), F.lit('" alt="'), alt, F.lit('">'))
    return F.coalesce(image, F.concat(F.lit('<span class="missing-asset">'), alt, F.lit("</span>")))


def _figures(role: str) -> Column:
    """Images of the assets of a role, each label once in order; none: empty."""
    labels = F.array_distinct(F.transform(F.filter("visual_assets", lambda a: (a["role"] == role) & (a["label"] != "")), lambda a: a["label"]))
    body = F.array_join(F.transform(labels, lambda x: render_asset(x, F.col("asset_sources"))), "")
    return F.when(F.size(labels) > 0, F.concat(F.lit('<div class="figures">'), body, F.lit("</div>"))).otherwise("")


def _option_blocks(letter: str) -> Column:
    """An option's blocks; its image's placeholder comes last if it is not among them, and alone where they only name the option."""
    blocks = _texts(F.col(f"options_latex.{letter}"))
    mark = F.nullif(F.try_element_at("option_assets", F.lit(letter))["placeholder"], F.lit(""))
    bare = F.forall(blocks, lambda b: F.rlike(b, F.lit(rf"^{letter}\s*[.．、:]?$")) | F.rlike(b, F.lit(M.VISUAL_BLOCK)))
    return F.when(mark.isNull(), blocks).when(bare, F.array(mark)).when(F.array_contains(blocks, mark), blocks).otherwise(F.concat(blocks, F.array(mark)))


def _option(letter: str, html: Column) -> Column:
    """An option of its rendered blocks: its image stands for its placeholder or, without one, behind them."""
    asset = F.try_element_at("option_assets", F.lit(letter))
    image = F.when(asset["label"] != "", render_asset(asset["label"], F.col("asset_sources"), "option-asset"))
    body = F.when(F.coalesce(asset["placeholder"], F.lit("")) == "", F.concat(html, F.coalesce(image, F.lit("")))).otherwise(F.replace(html, T.escape_html(asset["placeholder"]), F.coalesce(image, T.escape_html(asset["placeholder"]))))
    return _or_empty(body != "", F.concat(F.lit(f'<div class="option"><div class="option-key">{letter}.</div><div class="option-body">'), body, F.lit("</div></div>")))


def _section(title: str, kind: str, body: Column, folded: bool = False) -> Column:
    outer, head = ("details", "summary") if folded else ("div", "h3")
    return F.concat(F.lit(f'<{outer} class="qa-section {kind}"><{head}>{title}</{head}><div class="qa-body">'), body, F.lit(f"</div></{outer}>"))


def _or_empty(shown: Column, html: Column) -> Column:
    return F.when(shown, html).otherwise("")


def render_questions(records: DataFrame, run: str = "run_id") -> DataFrame:
    """(run, question_no, html): a section a record, with formulas, blanks and tables.

    Read where records have them: visual_assets (role, label), asset_sources (label to path) and option_assets (letter to placeholder and label).
    """
    defaults = {"visual_assets": "array<struct<role:string,label:string>>", "asset_sources": "map<string,string>", "option_assets": "map<string,struct<placeholder:string,label:string>>"}
    rows = records.withColumns({n: F.coalesce(F.col(n) if n in records.columns else F.lit(None), F.from_json(F.lit("{}" if k[0] == "m" else "[]"), k)) for n, k in defaults.items()})
    none = F.array().cast("array<string>")
    fields = ["stem_latex", *(s[1] for s in SECTIONS), *(f"options_latex.{k}" for k in "ABCD")]
    rows = with_tables(rows, F.concat(*(F.coalesce(F.col(f), none) for f in fields)))
    # Each piece is a column of its own, so it is rendered once, however often the page asks whether it is empty.
    tables, figures = F.col("tables"), ["stem_figure", *(s[5] for s in SECTIONS if s[5])]
    rows = rows.withColumns({f"_{f}": render_blocks(F.col(f), tables) for f in fields[:4]} | {f"_{k}": render_blocks(_option_blocks(k), tables) for k in "ABCD"} | {f"_{f}": _figures(f) for f in figures})
    rows = rows.withColumn("_options", F.concat(*(_option(k, F.col(f"_{k}")) for k in "ABCD")))
    shown = F.filter("issues", lambda i: i["type"] != "left_right_present")
    item = lambda i: F.concat(F.lit("<li><b>"), T.escape_html(i["severity"]), F.lit("</b> "), T.escape_html(i["type"]), F.lit(": "), T.escape_html(F.coalesce(i["message"], F.lit(""))), F.lit("</li>"))
    notes = F.concat(F.lit('<details class="issues"><summary>Issues</summary><ul>'), F.array_join(F.transform(shown, item), ""), F.lit("</ul></details>"))
    parts = []
    for title, field, kind, folded, pictures, role in SECTIONS:
        body = F.col(f"_{field}")
        parts.append(_or_empty(body != "", _section(title, kind, body, folded)))
        if role:
            parts.append(_or_empty(F.col(f"_{role}") != "", _section(pictures, kind.replace("section", "figures"), F.col(f"_{role}"))))
    stem = F.when(F.col("_stem_latex") == "", F.lit('<p class="empty">(empty)</p>')).otherwise(F.col("_stem_latex"))
    options = F.col("_options")
    html = F.concat(
        F.format_string('<section class="question" id="q%02d"><h2>Q%d <span>', F.col("question_no"), F.col("question_no")), T.escape_html(F.coalesce("question_type", F.lit("unknown"))),
        F.lit('</span></h2><div class="stem">'), stem, F.lit("</div>"),
        _or_empty(options != "", F.concat(F.lit('<div class="options">'), options, F.lit("</div>"))), F.col("_stem_figure"), *parts, _or_empty(F.coalesce(F.size(shown), F.lit(0)) > 0, notes), F.lit("</section>"),
    )
    return rows.select(run, "question_no", html.alias("html"))


def render_runs(records: DataFrame, run: str = "run_id") -> DataFrame:
    """(run, html): a page a run, its questions in order; a run is one paper."""
    parts = render_questions(records, run).groupBy(run).agg(F.array_sort(F.collect_list(F.struct("question_no", "html"))).alias("q"))
    body = F.array_join(F.transform("q", lambda x: x["html"]), "\n")
    head = F.concat(F.lit("<!DOCTYPE html><html><head><meta charset='utf-8'><title>"), T.escape_html(F.col(run)), F.lit("</title></head><body>"))
    return parts.select(run, F.concat(head, body, F.lit("</body></html>")).alias("html"))


def render_index(runs: DataFrame, rendered: DataFrame, run: str = "run_id") -> DataFrame:
    """(run, line): a link to the page of each run that is listed or rendered, once, in order; write_texts makes the index of them."""
    name = T.escape_html(F.col(run))
    line = F.concat(F.lit('<li><a href="'), name, F.lit('.html">'), name, F.lit("</a></li>"))
    return runs.select(run).union(rendered.select(run)).where(F.col(run).isNotNull()).distinct().select(run, line.alias("line")).orderBy(run)
