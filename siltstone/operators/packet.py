"""Review packets: a row's Markdown page, with what a reviewer needs and a list of what to check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.functions.variant import Node
from siltstone.sources.sinks import safe_name_column

HEAD = ("id", "source", "license", "design_family", "task_family", "split", "review_status", "created_by")
CHECKS = (
    "The prompt and the artifacts are complete.", "The license allows the use.", "The provenance names its source.", "The task type fits the artifacts.", "Each issue names signals that exist.",
    "Each issue names a module that exists.", "Timing is argued by the cycle.", "Reset behavior is right.", "No claim lacks its evidence.", "The verification plan can be run.", "The patch state agrees with the text.", "Nothing of the answer is in the prompt.",
)


def packets(rows: DataFrame) -> DataFrame:
    """SNK-4 and SNK-5: (id, name, page, raw): a file name, a Markdown page and the row's JSON."""
    v = Node("v")
    m = v["messages"]
    head = [F.concat(F.lit(f"- {k}: "), F.coalesce(v[k].text(), F.lit("missing"))) for k in HEAD]
    filled = F.map_filter(m[1]["content"]["artifacts"].fields(), lambda k, x: ~F.to_json(x).isin("null", '""'))
    art = F.transform(F.array_sort(F.map_keys(filled)), lambda k: F.concat(F.lit("### "), k, F.lit("\n\n```\n"), F.coalesce(F.try_variant_get(F.element_at(filled, k), "$", "string"), F.to_json(F.element_at(filled, k))), F.lit("\n```\n")))
    page = F.concat_ws(
        "\n", F.concat(F.lit("# "), F.coalesce(v["id"].text(), F.lit("row"))), F.lit(""), *head, F.lit("\n## Provenance\n"), v["provenance"].json(), F.lit("\n## Artifacts\n"), F.array_join(art, "\n"),
        F.lit("\n## Answer\n\n```json"), m[2]["content"].json(), F.lit("```\n\n## Checks\n"), *[F.lit(f"- [ ] {c}") for c in CHECKS],
    )
    named = rows.withColumn("id", F.coalesce(v["id"].text(), F.concat_ws(":", "file", F.col("line").cast("string"))))
    return named.select("id", safe_name_column("id", ".md").alias("name"), page.alias("page"), "raw")
