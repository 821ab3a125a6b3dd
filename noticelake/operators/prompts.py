"""Texts joined into prompts."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from noticelake.functions.text import ARCHIVE_SEPARATOR, DOCUMENT_SEPARATOR
from noticelake.operators.schema import ANALYSIS


#: What stands before an example's path (fixed wording).
EXAMPLE_LEAD = "Príklad dokumentu (z "


#: What a model is asked for.
INSTRUCTION = (
    "Prečítaj úradný dokument a odpovedz jediným záznamom JSON bez ďalšieho textu. Drž sa tejto šablóny, kľúče nemeň a nepridávaj. "
    "Čo v dokumente nie je, nechaj null alebo prázdny zoznam. Dátumy píš ako RRRR-MM-DD. Zhrnutie napíš po slovensky v niekoľkých vetách."
)


def joined(text: Column, order: Column, separator: str) -> Column:
    """Aggregate: the group's texts in order, null ones left out."""
    parts = F.sort_array(F.collect_list(F.when(text.isNotNull(), F.struct(order.alias("o"), text.alias("t")))))
    return F.array_join(F.transform(parts, lambda x: x["t"]), separator)


def archive_text(members: DataFrame, keys: list[str], order: str = "member", text: str = "text") -> DataFrame:
    """One text per archive from its members' texts; an archive without any has null."""
    return members.groupBy(*keys).agg(F.nullif(joined(F.col(text), F.col(order), ARCHIVE_SEPARATOR), F.lit("")).alias("text"))


def examples(sampled: DataFrame, store: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sampled documents with their stored texts (path, content), and those without one."""
    texts = store.filter("file_name = 'text.txt'").select("kraj", "okres", "doc_id", "content")
    rows = sampled.join(texts, ["kraj", "okres", "doc_id"], "left")
    path = F.concat_ws("/", "kraj", "okres", "doc_id", F.lit("text.txt"))
    return rows.filter("content IS NOT NULL").select("*", path.alias("path")), rows.filter("content IS NULL").drop("content")


def prompt(found: DataFrame, template: str) -> DataFrame:
    """One row, prompt: ``template`` with {examples} filled in. Empty without examples. For samples, which are small by intent."""
    one = F.concat(F.lit(EXAMPLE_LEAD), F.col("path"), F.lit("):\n\n"), F.col("content"))
    text = found.agg(joined(one, F.col("path"), DOCUMENT_SEPARATOR).alias("examples"), F.count(F.lit(1)).alias("n")).filter("n > 0")
    if template.count("{examples}") != 1:
        raise ValueError("the template needs {examples} exactly once")
    before, after = template.split("{examples}")
    return text.select(F.concat(F.lit(before), F.col("examples"), F.lit(after)).alias("prompt"))


def record_template(schema: StructType) -> dict:
    """An empty record of a schema: null for text and flags, empty lists, and one entry where a list holds records."""

    def empty(kind):
        if isinstance(kind, StructType):
            return {f.name: empty(f.dataType) for f in kind.fields}
        if isinstance(kind, ArrayType):
            return [empty(kind.elementType)] if isinstance(kind.elementType, StructType) else []
        return None

    return empty(schema)


def extraction(text: Column, schema: str = ANALYSIS) -> Column:
    """What a model is asked: to fill in the record's template from a document; null without text."""
    wanted = json.dumps(record_template(StructType.fromDDL(schema)), ensure_ascii=False, indent=2)
    return F.concat(F.lit(INSTRUCTION + "\n\n" + wanted + "\n\nText:\n\n"), text)
