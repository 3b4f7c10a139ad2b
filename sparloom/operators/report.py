"""Thin formatters over result frames: Markdown, HTML bars, terminal lines, JSON.

A report holds all rows of its frame, fetched partition by partition; ``most`` shortens it, and a
shortened report says so.
"""

from __future__ import annotations

import html
import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import ledger, liability

BLOCKS = "▁▂▃▄▅▆▇█"


def _rows(df: DataFrame, most: int | None = None) -> tuple[list[dict], bool]:
    """(rows in the frame's order, whether more were left out)."""
    rows = [r.asDict(recursive=True) for r in (df if most is None else df.limit(most + 1)).toLocalIterator()]
    return rows[:most], most is not None and len(rows) > most


def _cell(value) -> str:
    return "—" if value is None else f"{value:.1f}" if isinstance(value, float) else str(value).replace("|", "\\|").replace("\n", " ")


def markdown(df: DataFrame, title: str = "", most: int | None = None) -> str:
    head = [f"# {title}", ""] if title else []
    lines = ["| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
    rows, more = _rows(df, most)
    return "\n".join(head + lines + ["| " + " | ".join(_cell(r[c]) for c in df.columns) + " |" for r in rows] + [f"\nThe first {most} rows; there are more."] * more)


def sections(title: str, **frames: DataFrame) -> str:
    """A report of several tables, each under its name."""
    return "\n\n".join([f"# {title}", *(f"## {name.replace('_', ' ')}\n\n{markdown(df)}" for name, df in frames.items())])


def html_bars(df: DataFrame, label: str, value: str, title: str = "", most: int | None = None, width: int = 400) -> str:
    """A bar per row as inline SVG; negative values go left."""
    found, more = _rows(df, most)
    rows = [(str(r[label]), float(r[value] or 0)) for r in found]
    top = max((abs(v) for _, v in rows), default=1) or 1
    bars = []
    for i, (name, v) in enumerate(rows):
        size = abs(v) / top * width / 2
        left = width / 2 - (size if v < 0 else 0)
        bars.append(f'<text x="0" y="{i * 20 + 14}">{html.escape(name)}</text><rect x="{200 + left:.1f}" y="{i * 20 + 3}" width="{size:.1f}" height="14"/>')
    return f"<h2>{html.escape(title)}</h2><svg width=\"{width + 220}\" height=\"{20 * len(rows)}\">{''.join(bars)}</svg>{'<p>There are more.</p>' if more else ''}"


def html_stacked(df: DataFrame, label: str, parts: list[str], title: str = "", width: int = 400) -> str:
    """One bar per row, its parts side by side; parts below nought take no room."""
    rows = _rows(df)[0]
    sizes = [[max(0.0, float(r[p] or 0)) for p in parts] for r in rows]
    top = max((sum(s) for s in sizes), default=1) or 1
    bars = []
    for i, (r, own) in enumerate(zip(rows, sizes)):
        at = 200.0
        bars.append(f'<text x="0" y="{i * 20 + 14}">{html.escape(str(r[label]))}</text>')
        for k, (part, size) in enumerate(zip(parts, own)):
            bars.append(f'<rect class="part{k}" x="{at:.1f}" y="{i * 20 + 3}" width="{size / top * width:.1f}" height="14"><title>{html.escape(part)}</title></rect>')
            at += size / top * width
    return f"<h2>{html.escape(title)}</h2><svg width=\"{width + 220}\" height=\"{20 * len(rows)}\">{''.join(bars)}</svg>"


def html_forest(df: DataFrame, label: str, gap: str, ci: str, title: str = "", limit: float = -0.05, span: float = 0.5, width: int = 400) -> str:
    """Gaps with their intervals, and the limit as a line."""
    rows = _rows(df)[0]
    at = lambda x: 200 + min(1.0, max(0.0, (x + span) / (2 * span))) * width
    marks = [f'<line class="limit" x1="{at(limit):.1f}" x2="{at(limit):.1f}" y1="0" y2="{20 * len(rows)}"/>']
    for i, r in enumerate(rows):
        y = i * 20 + 10
        marks.append(f'<text x="0" y="{y + 4}">{html.escape(str(r[label]))}</text>')
        if r[gap] is not None:
            low, high = r[gap] - (r[ci] or 0), r[gap] + (r[ci] or 0)
            marks.append(f'<line x1="{at(low):.1f}" x2="{at(high):.1f}" y1="{y}" y2="{y}"/><circle cx="{at(r[gap]):.1f}" cy="{y}" r="4"/>')
    return f"<h2>{html.escape(title)}</h2><svg width=\"{width + 220}\" height=\"{20 * len(rows)}\">{''.join(marks)}</svg>"


def sparkline(values: list[float | None]) -> str:
    """One block per value between the least and the greatest; a gap for none."""
    known = [v for v in values if v is not None]
    low, span = (min(known), max(known) - min(known)) if known else (0, 0)
    return "".join(" " if v is None else BLOCKS[min(int((v - low) / span * (len(BLOCKS) - 1)), len(BLOCKS) - 1) if span else 0] for v in values)


def diverging(name: str, value: float, top: float, width: int = 20) -> str:
    size = round(abs(value) / top * width) if top else 0
    left, right = ("█" * size).rjust(width) if value < 0 else " " * width, "█" * size if value >= 0 else ""
    return f"{name:<20}{left}|{right}"


def forest(name: str, gap: float, ci: float, limit: float = -0.05, width: int = 41, span: float = 0.5) -> str:
    """A gap with its interval on a line from -span to span; ':' marks the limit."""
    at = lambda x: min(width - 1, max(0, round((x + span) / (2 * span) * (width - 1))))
    line = [" "] * width
    line[at(limit)] = ":"
    for i in range(at(gap - ci), at(gap + ci) + 1):
        line[i] = "-"
    line[at(gap)] = "o"
    return f"{name:<20}[{''.join(line)}] {gap:+.1%} ± {ci:.1%}"


def as_json(**frames: DataFrame) -> str:
    """One document of named row lists; one-row frames of 'total' names become objects."""
    made = {name: _rows(df)[0] for name, df in frames.items()}
    return json.dumps({k: v[0] if k.startswith("total") and len(v) == 1 else v for k, v in made.items()}, default=str, ensure_ascii=False)


def stats_json(rows: DataFrame, entries: DataFrame | None = None) -> str:
    """The ledger's aggregate as one document, with the liability of installed entries (null without them)."""
    tools, primers, total = ledger.by_tool(rows), ledger.primers(rows), ledger.totals(rows)
    listed = lambda df, *order: [r.asDict(recursive=True) for r in df.orderBy(*order).toLocalIterator()]
    counted = lambda df, key: {r[key]: r["blocks"] for r in df.orderBy(key).toLocalIterator()}
    owed = None
    if entries is not None:
        own = liability.liability(entries, tools, primers)
        owed = {"servers": listed(own, ledger.verdict_order(F.col("verdict")), "server")} | liability.totals(own, total).first().asDict()
    made = {
        "total": total.first().asDict(), "decisions": counted(ledger.by_decision(rows), "decision"), "diff_reasons": counted(ledger.by_diff_reason(rows), "diff_reason"),
        "versions": listed(ledger.by_version(rows), "version"), "tools": listed(tools, F.desc("saved_tokens"), "server", "tool"),
        "retrieves": listed(ledger.retrieves(rows), F.desc("tokens"), "server", "tool", "path"), "primers": listed(primers, "server", "cadence", "attached"), "primer_liability": owed,
    }
    return json.dumps(made, indent=2, ensure_ascii=False)


def verify_json(measured: DataFrame, corpus: str, column: str = "m") -> str:
    """Gates and savings of a corpus, measured as (tool, sha, ``column``), as one document."""
    m = lambda name: F.col(f"{column}.{name}")
    whole, inner = m("roundtrip_ok"), m("embedded_ok")
    sums = [F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(m("raw_tok")), F.lit(0)).alias("raw_tokens"), F.coalesce(F.sum(m("compressed_tok")), F.lit(0)).alias("packed_tokens")]
    bucket = lambda r: r | {"saved_tokens": r["raw_tokens"] - r["packed_tokens"], "saved_pct": round((r["raw_tokens"] - r["packed_tokens"]) / r["raw_tokens"] * 100, 1) if r["raw_tokens"] else 0.0}
    failed = lambda ok: [r.asDict() for r in measured.where(ok).select("tool", "sha", m("shape").alias("shape")).orderBy("tool", "sha").toLocalIterator()]
    all_ = measured.agg(*sums, F.count_if(whole).alias("whole"), F.count_if(whole & inner).alias("inner")).first().asDict()
    shapes = {r["shape"]: {k: r[k] for k in ("n", "raw_tokens", "packed_tokens")} for r in measured.groupBy(m("shape").alias("shape")).agg(*sums).orderBy("shape").toLocalIterator()}
    by_tool = {r["tool"]: r["n"] for r in measured.groupBy("tool").agg(F.count(F.lit(1)).alias("n")).orderBy("tool").toLocalIterator()}
    n, passed, fine = all_["n"], all_["whole"], all_["inner"]
    made = {
        "corpus": corpus, "payloads": n,
        "lossless_gate": {"ok": passed == n, "passed": passed, "total": n, "failures": failed(~whole)},
        "embedded_gate": {"ok": fine == passed, "passed": fine, "evaluated": passed, "total": n, "failures": failed(whole & ~inner)},
        "tokens": bucket({k: all_[k] for k in ("n", "raw_tokens", "packed_tokens")}), "by_shape": {k: bucket(v) for k, v in shapes.items()},
        "coverage": {"total": n, "by_tool": by_tool, "by_shape": {k: v["n"] for k, v in shapes.items()}},
    }
    return json.dumps(made, indent=2, ensure_ascii=False)
