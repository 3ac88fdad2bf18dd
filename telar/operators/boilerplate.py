"""Lines that repeat over the pages of a document, and footers that repeat over the articles of a site."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from telar import config as C
from telar.functions.text import canonical_line, is_page_number, word_count


def pages(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, page_no, line_no, line): the lines with content, pages being separated by form feeds or empty lines."""
    p = documents.select(F.col(doc_id).alias("doc_id"), F.posexplode(F.split(text, r"\f|\n[ \t]*\n")).alias("page_no", "page"))
    l = p.select("doc_id", "page_no", F.posexplode(F.split("page", "\n")).alias("line_no", "line"))  # noqa: E741
    return l.select("doc_id", "page_no", "line_no", F.trim("line").alias("line")).where("line <> ''")


def in_window(lines: DataFrame) -> DataFrame:
    """The first lines and the last of each page."""
    w = W.partitionBy("doc_id", "page_no")
    up, down = F.row_number().over(w.orderBy("line_no")), F.row_number().over(w.orderBy(F.desc("line_no")))
    return lines.withColumn("up", up).withColumn("down", down).where((F.col("up") <= C.HEAD_LINES) | (F.col("down") <= C.FOOT_LINES)).drop("up", "down")


def repeated_lines(lines: DataFrame) -> DataFrame:
    """(doc_id, forma, n_pages): line forms in the windows of enough pages; page numbers are set aside first."""
    body = in_window(lines.where(~is_page_number(F.col("line"))))
    n = lines.groupBy("doc_id").agg(F.count_distinct("page_no").alias("pages"))
    forms = body.groupBy("doc_id", canonical_line(F.col("line")).alias("forma")).agg(F.count_distinct("page_no").alias("n_pages"))
    # Joined by document: a document's forms are few beside its lines.
    enough = F.col("n_pages") >= F.greatest(F.lit(2), F.floor(F.col("pages") * C.REPEATED_SHARE))
    return forms.join(n, "doc_id").where((F.col("pages") >= 2) & enough).select("doc_id", "forma", "n_pages")


def clean(lines: DataFrame) -> DataFrame:
    """(doc_id, antes, despues, texto): documents without page numbers and repeated lines; left as they are where too many words would go.

    Only the counts and the text of a document's own lines are gathered; a document is one row.
    """
    kept = in_window(lines.where(~is_page_number(F.col("line")))).withColumn("forma", canonical_line(F.col("line")))
    drop = kept.join(repeated_lines(lines), ["doc_id", "forma"], "left_semi").select("doc_id", "page_no", "line_no")
    numbers = in_window(lines).where(is_page_number(F.col("line"))).select("doc_id", "page_no", "line_no")
    gone = drop.unionByName(numbers).distinct().withColumn("gone", F.lit(True))
    marked = lines.join(gone, ["doc_id", "page_no", "line_no"], "left").withColumn("n", word_count(F.col("line")))
    row = F.struct("page_no", "line_no", "line", "gone")
    doc = marked.groupBy("doc_id").agg(F.sum("n").alias("antes"), F.sum(F.when(F.col("gone").isNull(), F.col("n")).otherwise(0)).alias("despues"), F.array_sort(F.collect_list(row)).alias("rows"))
    too_much = F.col("antes") - F.col("despues") > C.REMOVABLE_SHARE * F.col("antes")
    left = F.when(too_much, F.col("rows")).otherwise(F.filter("rows", lambda x: x["gone"].isNull()))
    return doc.select("doc_id", "antes", F.when(too_much, F.col("antes")).otherwise(F.col("despues")).alias("despues"), F.array_join(F.transform(left, lambda x: x["line"]), "\n").alias("texto"))


def signature(line):
    """First and last words of a paragraph in small letters."""
    w = F.filter(F.split(F.lower(line), r"\s+"), lambda x: x != "")
    n = F.size(w)
    return F.concat_ws(" ", F.slice(w, 1, C.FOOTER_WORDS)), F.concat_ws(" ", F.slice(w, F.greatest(F.lit(1), n - C.FOOTER_WORDS + 1), F.lit(C.FOOTER_WORDS)))


def paragraphs(documents: DataFrame, site: str = "source") -> DataFrame:
    """(site, doc_id, par_no, par, last, firma): paragraphs with their signatures."""
    p = documents.where(F.col("text").isNotNull()).select(F.col(site).alias("site"), "doc_id", F.filter(F.transform(F.split("text", "\n"), F.trim), lambda x: x != "").alias("ps"))
    p = p.select("site", "doc_id", F.size("ps").alias("n"), F.posexplode("ps").alias("par_no", "par"))
    head, tail = signature(F.col("par"))
    return p.select("site", "doc_id", "par_no", "par", (F.col("par_no") == F.col("n") - 1).alias("last"), F.concat(head, F.lit(" … "), tail).alias("firma"))


def footers(paragraphs_: DataFrame) -> DataFrame:
    """(site, firma, n): signatures that close enough articles of a site and never stand inside one.

    Two mergeable counts per signature: no join and no group of articles.
    """
    by = paragraphs_.groupBy("site", "firma").agg(F.count_if("last").alias("n"), F.count_if(~F.col("last")).alias("inside"))
    return by.where((F.col("n") >= C.FOOTER_ARTICLES) & (F.col("inside") == 0)).select("site", "firma", "n")


def without_footers(paragraphs_: DataFrame) -> DataFrame:
    """(doc_id, recortados): how many closing paragraphs of each document are footers of its site."""
    hit = paragraphs_.join(footers(paragraphs_).select("site", "firma", F.lit(True).alias("foot")), ["site", "firma"], "left")
    last_text = F.max(F.when(F.col("foot").isNull(), F.col("par_no")).otherwise(-1))
    return hit.groupBy("doc_id").agg((F.max("par_no") - last_text).cast("int").alias("recortados")).where("recortados > 0")


def survivors(lines: DataFrame) -> DataFrame:
    """(doc_id, forma, n_pages): forms on two pages or more, below the threshold, that are part of a form above it."""
    removed = repeated_lines(lines)
    body = in_window(lines.where(~is_page_number(F.col("line"))))
    forms = body.groupBy("doc_id", canonical_line(F.col("line")).alias("forma")).agg(F.count_distinct("page_no").alias("n_pages")).where("n_pages >= 2")
    low = forms.join(removed.select("doc_id", "forma"), ["doc_id", "forma"], "left_anti")
    # Forms of one document against those removed from it: both sides are bounded by a page's windows.
    r = removed.select("doc_id", F.col("forma").alias("whole"))
    return low.join(r, "doc_id").where("contains(whole, forma) AND whole <> forma").select("doc_id", "forma", "n_pages").distinct()


def joined_pages(lines: DataFrame) -> DataFrame:
    """(doc_id, page_no, grupo): pages that go on with the sentence of the page before belong to its group.

    Only the first and the last line of each page are looked at.
    """
    w = W.partitionBy("doc_id").orderBy("page_no")
    page = lines.groupBy("doc_id", "page_no").agg(F.min_by("line", "line_no").alias("first"), F.max_by("line", "line_no").alias("last"))
    open_ = ~F.lag("last").over(w).rlike(r"[.!?…:;。！？।؟][\"'”»)\]]*$")
    goes_on = F.coalesce(open_ & F.col("first").rlike(r"^\p{Ll}"), F.lit(False))
    return page.withColumn("new", F.when(goes_on, 0).otherwise(1)).select("doc_id", "page_no", F.sum("new").over(w).cast("int").alias("grupo"))


def isolated_lines(lines: DataFrame) -> DataFrame:
    """(doc_id, page_no, line_no, line): short open lines that are no prose: numbered, labels, titles, capitals; what is before is closed and what follows begins anew."""
    w = W.partitionBy("doc_id", "page_no").orderBy("line_no")
    closed = r"[.!?…:;。！？।؟][\"'”»)\]]*$"
    look = F.col("line").rlike(r"^\s*(?:[0-9]+(?:\.[0-9]+)*[.)]?\s|[IVXLC]+\.\s|[A-Za-z]\)\s)") | F.col("line").rlike(r"^[\p{L} ]{2,30}:\s*\S*$") | (F.upper("line") == F.col("line")) & F.col("line").rlike(r"\p{Lu}{2}") | F.col("line").rlike(r"^\p{Lu}[^.!?]*$")
    rows = lines.withColumn("before", F.lag("line").over(w)).withColumn("after", F.lead("line").over(w))
    alone = (F.col("before").isNull() | F.col("before").rlike(closed)) & (F.col("after").isNull() | ~F.col("after").rlike(r"^\p{Ll}"))
    return rows.where((word_count(F.col("line")) <= C.DANGLING_WORDS) & ~F.col("line").rlike(closed) & look & alone).select("doc_id", "page_no", "line_no", "line")
