"""What a collection holds, as Markdown; rendered on the driver from a manifest, one row a partition."""

from __future__ import annotations

from parchment.plans.runner import status
from parchment.schema import DOCUMENTS
from parchment.sources.catalog import CATEGORIES, COLLECTIONS, Collection

SHOWN = 25


def counted(n: int, one: str) -> str:
    return f"{n:,} {one}{'' if n == 1 else 's'}"


def size_category(rows: int) -> str:
    return next((label for limit, label in ((1_000, "n<1K"), (10_000, "1K<n<10K"), (100_000, "10K<n<100K"), (1_000_000, "100K<n<1M")) if rows < limit), "1M<n<10M")


def code_points(points: dict[str, int]) -> str:
    """Two kinds of characters that don't say what a page shows."""
    if not points["private_use"] and not points["replacement"]:
        return "No text holds a private-use or replacement character."
    parts = [f"{counted(points[f'{k}_rows'], 'row')} with {counted(points[k], name)}" for k, name in (("private_use", "private-use character"), ("replacement", "replacement character")) if points[k]]
    return f"{' and '.join(parts)}."


def table(head: list[str], rows: list[list]) -> list[str]:
    return ["| " + " | ".join(head) + " |", "|" + "---|" * len(head), *("| " + " | ".join(str(c).replace("|", "/") for c in r) + " |" for r in rows)]


def collection_card(collection: Collection, manifest: dict) -> str:
    """Front matter, status, failures, partitions and schema."""
    held = status(manifest)
    failures = sorted(manifest["failures"].items())
    out = ["---", f"pretty_name: {collection.title}", f"size_categories: [{size_category(held['rows'])}]", "---", "", f"# {collection.title}", ""]
    out += [f"{counted(held['rows'], 'row')}, of which {held['listed']:,} are listed now; {held['file_bytes'] / 1e9:,.2f} GB of files.", ""]
    out += ["Every file of the last complete listing is stored." if held["whole"] else "Not every listed file is stored, or no listing was read to its end.", ""]
    if failures:
        out += ["## Files not stored", "", *table(["File", "Attempts", "Last error"], [[k, f["attempts"], f["error"]] for k, f in failures[:SHOWN]])]
        out += [f"... {len(failures) - SHOWN:,} more"] if len(failures) > SHOWN else []
        out.append("")
    out += ["## Partitions", "", *table([collection.partition_label, "Rows", "Listed"], [[k, f"{e['rows']:,}", f"{e.get('listed', 0):,}"] for k, e in sorted(manifest["partitions"].items(), reverse=True)]), ""]
    out += ["## Schema", "", *table(["Column", "Type"], [[f.name, f.dataType.simpleString()] for f in DOCUMENTS]), ""]
    return "\n".join(out)


def category_card(category: str, manifests: dict[str, dict]) -> str:
    """A category's collections, those without a manifest too."""
    rows = []
    for c in COLLECTIONS.values():
        if c.category == category:
            held = status(manifests[c.name]) if c.name in manifests else None
            rows.append([c.title, f"{held['rows']:,}" if held else "0", f"{held['listed']:,}" if held else "0", ("whole" if held["whole"] else "incomplete") if held else "not started"])
    return "\n".join([f"# {CATEGORIES[category][0]}", "", *table(["Collection", "Rows", "Listed", "State"], rows), ""])


def cases_card(coverage: list[tuple]) -> str:
    """coverage: (term or None for all, cases, with page, with opinion, with transcript, with audio)."""
    rows = [["all" if r[0] is None else r[0], *(f"{n:,}" for n in r[1:])] for r in sorted(coverage, key=lambda r: (r[0] is None, -(r[0] or 0)))]
    return "\n".join(["# Cases", "", *table(["Term", "Cases", "Docket page", "Opinion", "Transcript", "Audio"], rows), ""])
