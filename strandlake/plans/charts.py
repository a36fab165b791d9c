"""Charts of a run as SVG: plain text, drawn from one value or one box a sample."""

from __future__ import annotations

import base64
import html
import math

from strandlake.functions.axis import dark, figure_size, log_ticks, nice_step

#: Pixels of an inch; room for the axis at the left and the names below.
INCH, LEFT, BELOW, ABOVE = 80, 70, 60, 30


def _frame(title: str, n: int, ticks: list[float], place, body: str, names: list[str]) -> str:
    width, height = (INCH * x for x in figure_size(n))
    lines = "".join(f'<line x1="{LEFT}" x2="{width:.0f}" y1="{place(t):.1f}" y2="{place(t):.1f}" stroke="#ddd"/><text x="{LEFT - 6}" y="{place(t) + 4:.1f}" text-anchor="end">{number(t)}</text>' for t in ticks)
    slot = (width - LEFT) / max(n, 1)
    below = "".join(f'<text x="{LEFT + slot * (k + 0.5):.1f}" y="{height - BELOW + 18:.0f}" text-anchor="middle">{html.escape(name)}</text>' for k, name in enumerate(names))
    return f'<svg xmlns="http://www.w3.org/2000/svg" width="{width:.0f}" height="{height:.0f}" font-family="sans-serif" font-size="12"><text x="{LEFT}" y="18" font-size="15">{html.escape(title)}</text>{lines}{body}{below}</svg>'


def number(x: float) -> str:
    """With marks between thousands; up to three digits behind the point."""
    return f"{x:,.0f}" if float(x).is_integer() else f"{x:,.3f}".rstrip("0")


def bars(title: str, values: list[tuple[str, float]], color: tuple[float, float, float] = (0.2, 0.4, 0.6)) -> str:
    """A bar and its number for each sample."""
    width, height = (INCH * x for x in figure_size(len(values)))
    most = max((v for _, v in values), default=1) or 1
    power = 10.0 ** math.floor(math.log10(most))
    step = power * nice_step(most / power / 5)
    top = step * math.ceil(most / step)
    place = lambda v: height - BELOW - (height - BELOW - ABOVE) * v / top
    slot = (width - LEFT) / max(len(values), 1)
    fill = "#" + "".join(f"{round(255 * c):02x}" for c in color)
    ink = "#fff" if dark(*color) else "#000"
    body = "".join(f'<rect x="{LEFT + slot * (k + 0.15):.1f}" y="{place(v):.1f}" width="{slot * 0.7:.1f}" height="{place(0) - place(v):.1f}" fill="{fill}"/><text x="{LEFT + slot * (k + 0.5):.1f}" y="{place(v / 2):.1f}" text-anchor="middle" fill="{ink}">{number(v)}</text>' for k, (_, v) in enumerate(values))
    return _frame(title, len(values), [k * step for k in range(round(top / step) + 1)], place, body, [s for s, _ in values])


def boxes(title: str, values: list[tuple[str, float, float, float, float, float]]) -> str:
    """A box (low, first quartile, median, third quartile, high) for each sample, on a logarithmic axis; values are over 0."""
    width, height = (INCH * x for x in figure_size(len(values)))
    low, high = min((v[1] for v in values), default=1), max((v[5] for v in values), default=10)
    a, b = math.log10(low), math.log10(high) if high > low else math.log10(low) + 1
    place = lambda v: height - BELOW - (height - BELOW - ABOVE) * (math.log10(v) - a) / (b - a)
    slot, body = (width - LEFT) / max(len(values), 1), []
    for k, (_, lo, q1, q2, q3, hi) in enumerate(values):
        x, w = LEFT + slot * (k + 0.25), slot * 0.5
        body.append(f'<line x1="{x + w / 2:.1f}" x2="{x + w / 2:.1f}" y1="{place(lo):.1f}" y2="{place(hi):.1f}" stroke="#333"/><rect x="{x:.1f}" y="{place(q3):.1f}" width="{w:.1f}" height="{max(1.0, place(q1) - place(q3)):.1f}" fill="#9bc" stroke="#333"/><line x1="{x:.1f}" x2="{x + w:.1f}" y1="{place(q2):.1f}" y2="{place(q2):.1f}" stroke="#000" stroke-width="2"/>')
    return _frame(title, len(values), [t for t in log_ticks(low, high) if t > 0], place, "".join(body), [v[0] for v in values])


def as_image(svg: str) -> str:
    """The chart as an address that an image tag takes."""
    return "data:image/svg+xml;base64," + base64.b64encode(svg.encode()).decode()
