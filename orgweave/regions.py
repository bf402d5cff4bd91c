"""Regions as parameters: one engine, a row for each place."""

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Region:
    """centre: fallback coordinates; filter_at, filter_km: the distance filter; postal, names
    and phones: patterns of a local address; page_chars: text kept of a page."""

    name: str
    centre: tuple[float, float]
    filter_at: tuple[float, float]
    filter_km: float
    country: str
    language: str
    suffix: str
    postal: str
    names: tuple[str, ...]
    phones: tuple[str, ...] = field(default=())
    page_chars: int = 15_000


# The three regions.
REGIONS = {
    "hamburg": Region(
        "hamburg", (53.550341, 10.000654), (53.5511, 9.9937), 30.0, "de", "de", ", Hamburg, Germany", r"\b2[0-2][0-9]{3}\b",
        ("hamburg", "altona", "eimsbüttel", "wandsbek", "bergedorf", "harburg"), (r"\+49 40", r"\b040\b"),
    ),
    "novi_sad": Region(
        "novi_sad", (45.2671, 19.8335), (45.2671, 19.8335), 20.0, "rs", "sr", ", Novi Sad, Serbia", r"\b21[0-9]{3}\b",
        ("novi sad", "нови сад", "petrovaradin", "петроварадин", "futog", "футог", "veternik", "ветерник", "sremska kamenica", "сремска каменица", "begeč", "бегеч", "serbia", "србија", "srbija"), (r"\+381 21", r"\b021\b", r"\+381 \(0\)21"), 8_000,
    ),
    "cahul": Region(
        "cahul", (45.908298, 28.194431), (45.9074, 28.1947), 12.0, "md", "ro", ", Cahul, Moldova", r"MD-[0-9]{4}",
        ("cahul", "congaz", "giurgiulești", "giurgiulesti", "raionul cahul", "moldova"), (r"\+373",),
    ),
}
