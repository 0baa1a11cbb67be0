"""Expected listings of the rebuilt captures, straight from the facts they were built from."""

from . import captures, fixed
from .captures import CITIES, PLACES, TITLES
from .oracle import HOUSES, PART_CACHE, SEQ, _walk, houses, listing, pick

TYPES = {
    "price": "DOUBLE", "houseSqm": "DOUBLE", "plotSqm": "DOUBLE", "beds": "INTEGER", "baths": "INTEGER",
    "buildYear": "INTEGER", "postedTs": "BIGINT", "n_images": "INTEGER",
}
# What each resolver makes of the place words.
SUBSTRING = ("Paphos", "Other", "Other", "Limassol", "Other", "Other")
ALIAS = ("Paphos", "Nicosia", "Famagusta", None, "Limassol", None)
SEGMENT = ("Paphos", "Nicosia", "Ayia Napa", "Limassol", "Limassol", "Somewhere")
WORD = ("Paphos", None, None, "Limassol", None, None)
# What the taxonomies make of the city terms.
PAFILIA = ("Limassol", "Paphos", "Paphos", None, "Famagusta", "Nicosia", None, None)
GIOVANI = (None, None, None, None, None, "Nicosia", "Famagusta", "Famagusta")

ASKING = "CASE WHEN p <> 0 THEN '€' || pc END"
POSTED = """strftime(epoch_ms("postedTs"), '%-d %b %Y')"""
SITE = fixed.SITES
SIZES = {"houseSqm": '"houseSqm"', "beds": "beds", "baths": "baths"}


def expect(
    source: str, kind: str, fields: dict[str, str], unique: str | None = "id", order: str = "seq", valid: str = "true", wanted: str = "true"
) -> str:
    first = f"QUALIFY row_number() OVER (PARTITION BY {unique} ORDER BY {order}) = 1" if unique else ""
    shown = []
    for name in (*captures.OUT, "n_images"):
        if name in ("source", "kind"):
            shown.append(f"'{source if name == 'source' else kind}' AS {name}")
        else:
            shown.append(f'CAST({fields.get(name, "NULL")} AS {TYPES.get(name, "VARCHAR")}) AS "{name}"')
    return f"""WITH {HOUSES}, f AS (SELECT *, CAST(price AS BIGINT) AS p, format('{{:,}}', CAST(price AS BIGINT)) AS pc,
  replace(format('{{:,}}', CAST(price AS BIGINT)), ',', '.') AS pd, {pick(PLACES, "seq")} AS place,
  CAST("houseSqm" AS BIGINT) AS area, CAST("plotSqm" AS BIGINT) AS plot,
  {pick(CITIES, "seq % 25")} AS city1, {pick(CITIES, "(seq + 1) % 25")} AS city2,
  seq - CASE WHEN seq % 10 = 9 THEN 1 ELSE 0 END AS id FROM houses),
b AS (SELECT * FROM f WHERE {valid} {first})
SELECT {", ".join(shown)}, {order.split(",")[0] if "," in order else "0"} AS walk_part, seq AS walk_seq FROM b WHERE {wanted}"""


def agency(site: str, name: str, default: str) -> dict[str, str]:
    return {
        "ref": "id", "title": f"CASE WHEN seq % 5 <> 0 THEN {name} ELSE '{default}' END", "price": "p", "priceDisplay": ASKING,
        "location": "CASE WHEN seq % 7 <> 0 THEN place || ', X' ELSE 'Cyprus' END",
        "district": f"CASE WHEN seq % 7 <> 0 THEN {pick(SEGMENT, 'seq')} END",
        "image": "'https://estbd.io/1/' || seq || '.jpg'", "n_images": "2", "link": f"{site} || '/property-' || id || '/x'",
    }


def kazo(kind: str) -> str:
    noun = "Tourist plot " if kind == "plot" else "Villa "
    area = "plot" if kind == "plot" else "area"
    both = "beds IS NOT NULL AND baths IS NOT NULL"
    resolved = tuple(d if i not in (2, 5) else f"{noun}{d}" for i, d in enumerate(SEGMENT))
    place = f"CASE WHEN seq % 3 = 0 THEN 'larnaka' WHEN seq % 5 = 0 THEN 'Sea View Villa' ELSE {pick(resolved, 'seq')} END"
    # In the unlabelled form a bare area of four digits after the symbol reads as the price.
    price = f"CASE WHEN seq % 2 = 1 AND NOT ({both}) AND p IS NOT NULL AND {area} >= 1000 THEN {area} ELSE nullif(p, 0) END"

    def count(c: str) -> str:
        return f"CASE WHEN seq % 2 = 0 THEN {c} WHEN {both} AND {area} IS NOT NULL THEN {c} END"

    fields = {
        "ref": "id", "title": f"CASE WHEN seq % 5 = 0 THEN 'Sea View Villa' ELSE '{noun}' || place END", "price": price,
        "priceDisplay": f"'€' || format('{{:,}}', CAST({price} AS BIGINT))", "location": place, "district": place,
        "image": "'https://estbd.io/1/' || seq || '/a.jpg'", "n_images": "1",
        "link": "'https://kazo.com.cy/property/sea-view-villa-' || id", "beds": count("beds"), "baths": count("baths"),
        "plotSqm" if kind == "plot" else "houseSqm": area,
    }
    if kind == "plot":
        fields["plotType"] = "CASE WHEN seq % 5 <> 0 THEN 'Tourist' END"
    return expect("Kazo Real Estate", kind, fields, wanted=f"{price} IS NOT NULL")


def bazaraki(kind: str) -> str:
    place = pick(fixed.BAZARAKI_PARTITIONS, "seq")
    fields = {
        "ref": "id", "title": "'House ' || seq", "price": "nullif(p, 0)",
        "priceDisplay": "CASE WHEN p <> 0 THEN CASE WHEN seq % 2 = 0 THEN '$' ELSE '€' END || pc END",
        "location": place, "district": place, "image": "'https://o.test/' || seq || '.jpg'", "n_images": "2",
        "link": f"'{SITE['Bazaraki']}/adv/' || id || '_s-' || seq || '/'", "plotSqm": "plot", "posted": POSTED,
        "postedTs": '"postedTs"',
    }
    if kind == "plot":
        fields |= {
            "title": pick(TITLES, "seq"), "plotType": pick(("Commercial", None, None, "Tourist"), "seq"),
            "zone": "CASE WHEN seq % 5 = 0 THEN 'Ka' || (seq % 9) END",
        }
    else:
        fields |= SIZES | {"buildYear": '"buildYear"'}
    return expect("Bazaraki", kind, fields, order="seq % 5, seq", valid="seq % 50 <> 0")


def cyprus_properties(kind: str) -> str:
    fields = {
        "ref": "id", "title": "'A & B ' || seq", "price": "p", "priceDisplay": ASKING, "location": "place",
        "district": pick(SEGMENT, "seq"), "image": "'https://estbd.io/' || seq || '.jpg'", "n_images": "1",
        "link": f"'{SITE['Cyprus Properties']}/property/' || id", "beds": "beds", "baths": "baths",
    }
    if kind == "plot":
        fields |= {
            "title": f"{pick(TITLES, 'seq')} || ' ' || seq", "plotSqm": "plot",
            "plotType": pick(("Commercial", None, None, "Tourist"), "seq"),
        }
        return expect("Cyprus Properties", kind, fields, wanted="p IS NOT NULL")
    return expect(
        "Cyprus Properties", kind, fields | {"houseSqm": "area"}, unique="id, seq % 2", order="seq % 2, seq", wanted="p IS NOT NULL"
    )


def nch(kind: str) -> str:
    site = f"CASE WHEN seq % 4 = 0 THEN 'https://other.test' ELSE 'https://{fixed.NCH_HOST}' END"
    default = "Plot for sale" if kind == "plot" else "House for sale"
    fields = agency(site, "'Home ' || seq", default) | {"beds": "beds", "baths": "baths"}
    fields["plotSqm" if kind == "plot" else "houseSqm"] = "plot" if kind == "plot" else "area"
    return expect("NCH Real Estate", kind, fields, wanted=f"p IS NOT NULL AND beds IS {'' if kind == 'plot' else 'NOT'} NULL")


def kadis(kind: str) -> str:
    if kind == "plot":
        fields = agency("'https://kadis.com.cy'", f"{pick(TITLES, 'seq')} || ' ' || seq", "Plot for sale") | {
            "plotSqm": "plot",
            "plotType": f"CASE WHEN seq % 5 <> 0 THEN {pick(('Commercial', 'Agricultural', None, 'Tourist'), 'seq')} END",
        }
    else:
        fields = agency("'https://kadis.com.cy'", "'House ' || seq", "House for sale") | SIZES | {"houseSqm": "area * 10 + 5"}
    return expect("Kadis Estates", kind, fields)


def post(source: str, districts, valid: str, fields: dict[str, str], wanted: str = "true") -> str:
    common = {
        "ref": "seq", "title": "'A & B – ' || seq", "location": "city1 || ', ' || city2",
        "district": f"coalesce({pick(districts, 'seq % 25')}, {pick(districts, '(seq + 1) % 25')})",
        "image": "CASE WHEN seq % 3 <> 0 THEN 'https://m.test/' || seq || '.jpg' END",
        "n_images": "CASE WHEN seq % 3 <> 0 THEN 1 ELSE 0 END", "posted": POSTED, "postedTs": '"postedTs"',
    }
    wanted = wanted.replace("DISTRICT", common["district"])
    return expect(source, "house", common | fields, unique=None, valid=valid, wanted=wanted)


# The district's final spelling, then what the cache and the detail pages of `captures.py` bring.
CANON = """CASE district WHEN 'Pafos' THEN 'Paphos' WHEN 'Lefkosia' THEN 'Nicosia' WHEN 'Ammochostos' THEN 'Famagusta'
  WHEN 'Germasogeia' THEN 'Limassol' WHEN 'Lemesos' THEN 'Limassol' ELSE district END"""
SEEN = "s.source IN ('Realting', 'Kadis Estates') AND TRY_CAST(s.ref AS BIGINT) % 2 = 1"
KEY = "TRY_CAST(s.ref AS BIGINT)"
ENRICHED = f"""SELECT s.* REPLACE (
  CASE WHEN s.source = 'eAuction Cyprus' THEN NULL WHEN {SEEN} AND s.source = 'Realting' THEN coalesce(s."houseSqm", 50 + {KEY} % 300)
    ELSE s."houseSqm" END AS "houseSqm",
  CASE WHEN s.source = 'eAuction Cyprus' THEN c."plotSqm" WHEN {SEEN} THEN 101 + {KEY} % 900 ELSE s."plotSqm" END AS "plotSqm",
  CASE WHEN s.source = 'eAuction Cyprus' THEN c.image ELSE s.image END AS image)
FROM scraped s LEFT JOIN (SELECT 'Q' || substr(ref, 2) || '-001' AS code, * FROM ({PART_CACHE})) c
  ON s.source = 'eAuction Cyprus' AND s.ref = c.code"""


def refreshed(kind: str, found: dict[str, str], enriched: str = "SELECT * FROM scraped") -> str:
    """The walk over all sources' expected listings: CTEs ``ready`` (listings) and ``decided``."""
    priority = fixed.HOUSE_PRIORITY if kind == "house" else fixed.PLOT_PRIORITY
    registry = fixed.HOUSE_REGISTRY if kind == "house" else fixed.PLOT_REGISTRY
    parts = " UNION ALL ".join(f"SELECT *, {registry.index(name)} AS walk_source FROM ({text})" for name, text in found.items())
    area = 'beds, "houseSqm" AS area' if kind == "house" else '"plotSqm" AS area'
    rows = f"""scraped AS MATERIALIZED (SELECT * REPLACE ({CANON} AS district),
  row_number() OVER (ORDER BY walk_source, walk_part, walk_seq) AS seq FROM ({parts})),
ready AS MATERIALIZED ({enriched}),
r AS MATERIALIZED (SELECT seq, source, CAST(list_position({listing(priority)}, source) - 1 AS BIGINT) AS rank,
  CAST(list_position({listing(priority)}, source) - 1 AS BIGINT) * {SEQ} + seq AS ord,
  nullif(regexp_replace(lower(coalesce(link, '')), '/+$', ''), '') AS lk, price, district, {area} FROM ready)"""
    return _walk(kind, rows, len(priority))


def sql() -> dict[str, str]:
    bed_title = "CASE WHEN beds IS NOT NULL THEN beds || '{}' ELSE '{}' END"
    root = SITE["Altamira Real Estate"]
    auction_place = f"CASE WHEN seq % 4 = 0 THEN 'Other' ELSE {pick(('Paphos', 'Limassol', 'Kyrenia'), 'seq')} END"
    out = {
        ("Altamira", "house"): expect(
            "Altamira Real Estate", "house",
            SIZES | {
                "ref": "'AB' || (10000 + seq % 90000)", "title": "'House ' || seq || ' - ' || place || ' - sea'",
                "price": "nullif(p, 0)", "priceDisplay": "'€' || pc", "location": "place || ' - sea'", "district": pick(SUBSTRING, "seq"),
                "image": f"CASE WHEN seq % 2 = 0 THEN '{root}/i/' || seq || '.jpg' ELSE nullif(image, '') END",
                "link": f"CASE seq % 3 WHEN 0 THEN '{root}' WHEN 1 THEN '{root}/a/' || seq ELSE 'https://z.test/' || seq END",
            },
            unique=None, wanted="p IS NOT NULL",
        ),
        ("eAuction", "house"): expect(
            "eAuction Cyprus", "house",
            {
                "ref": "'Q' || id || '-001'", "price": "p", "priceDisplay": "CASE WHEN p <> 0 THEN '€' || pc || ' (reserve price)' END",
                "auctionDate": '"auctionDate"', "status": "'Open'", "posted": "'05/03/2026'", "district": auction_place,
                "location": f"CASE WHEN seq % 5 <> 0 THEN 'Agios-' || seq || ', Kato Poli, ' ELSE '' END || {auction_place}",
                "title": f"'Residence auction — ' || CASE WHEN seq % 5 <> 0 THEN 'Kato Poli' ELSE {auction_place} END",
                "link": f"CASE WHEN seq % 3 <> 0 THEN '/Auction/Details/' || seq ELSE '{SITE['eAuction Cyprus']}{fixed.EAUCTION_LIST_PATH}' END",
            },
            order="seq % 5, seq", valid="seq % 5 <> 4",
        ),
        ("Zyprus", "house"): expect(
            "Zyprus", "house",
            {
                "ref": "seq", "title": bed_title.format(" Bedroom house for sale", "House FOR SALE"), "price": "nullif(coalesce(p, 77777), 0)",
                "priceDisplay": "'€ ' || coalesce(pc, '77,777')", "location": "place", "district": pick(SUBSTRING, "seq"), "beds": "beds",
                "image": "image", "link": "'https://z.test/property/' || seq || '/x'",
            },
            unique=None,
        ),
        ("BidX1", "house"): expect(
            "BidX1", "house",
            {
                "ref": "seq", "title": "'some long house name ' || seq", "price": "p", "priceDisplay": "'€ ' || pd || ' (reserve)'",
                "location": "place || ', Cyprus'", "district": pick(SUBSTRING, "seq"), "beds": "beds", "image": "image",
                "link": f"'{SITE['BidX1']}/auction/property/' || seq",
            },
            unique=None,
        ),
        ("BuySellCyprus", "house"): expect(
            "BuySellCyprus", "house",
            {
                "ref": "id", "title": bed_title.format(" Bedroom house for sale", "House for sale"), "price": "p",
                "priceDisplay": "coalesce('From €' || pc, 'POA')", "location": "place", "image": "image", "beds": "beds",
                "link": "'https://b.test/' || id || '.html'", "houseSqm": "area", "plotSqm": "plot", "buildYear": '"buildYear"',
            },
            wanted="seq % 6 <> 0",
        ),
        ("home.cy", "house"): expect(
            "home.cy", "house",
            SIZES | {
                "ref": "id", "title": "CASE WHEN seq % 2 = 0 THEN 'Villa for sale' ELSE 'House for sale' END", "price": "p",
                "priceDisplay": ASKING, "location": "CASE WHEN area IS NOT NULL THEN place END",
                "district": "CASE WHEN area IS NOT NULL THEN 'Paphos' END", "agent": "'Agent ' || seq", "image": "image",
                "link": "'https://h.test/x-' || id",
            },
        ),
        ("FOX Realty", "house"): expect(
            "FOX Realty", "house",
            {
                "ref": "id", "title": "'Villa for sale'", "price": "p", "priceDisplay": ASKING, "location": "'Old Town'",
                "district": "place || ' north'", "houseSqm": "nullif(coalesce(area, plot), 0)",
                "plotSqm": "CASE WHEN area IS NOT NULL THEN nullif(plot, 0) END",
                "beds": "CASE WHEN baths IS NOT NULL THEN beds END", "baths": "CASE WHEN beds IS NOT NULL THEN baths END",
                "image": "image", "link": "'https://f.test/property/' || id",
            },
            order="seq % 5, seq",
        ),
        ("Realting", "house"): expect(
            "Realting", "house",
            {
                "ref": "id", "title": bed_title.format(" bedroom villa ", "villa ") + " || seq", "price": "p", "priceDisplay": ASKING,
                "location": "place || ', Cyprus'", "district": pick(ALIAS, "seq"), "houseSqm": "area", "beds": "beds",
                "image": "'https://realting.com/uploads/' || seq || '.webp'", "link": f"'{SITE['Realting']}/cyprus/property/' || id",
            },
            wanted="p <> 0",
        ),
        ("A Place in the Sun", "house"): expect(
            "A Place in the Sun", "house",
            {
                "ref": "'ap' || id", "title": bed_title.format(" Bed villa", "villa"), "price": "p", "priceDisplay": "'€' || pc",
                "location": "CASE WHEN seq % 7 = 0 THEN 'Cyprus' WHEN seq % 2 = 0 THEN 'Pafos, ' || place ELSE place END",
                "district": "CASE WHEN seq % 7 = 0 THEN NULL WHEN seq % 2 = 0 THEN 'Paphos' ELSE place END", "beds": "beds",
                "image": "'https://www.aplaceinthesun.com/property/media/images/' || seq || '.jpg'",
                "link": f"'{SITE['A Place in the Sun']}/property/details/ap' || id || '/n'",
            },
            wanted="p IS NOT NULL",
        ),
        ("DOM real estate", "house"): expect(
            "DOM real estate", "house",
            {
                "ref": "id", "title": "'Villa in ' || place || ' / Old Town'", "price": "p", "priceDisplay": ASKING,
                "location": "place || ', Old Town'", "district": pick(WORD, "seq"), "houseSqm": "area + 1", "plotSqm": "plot + 1",
                "beds": "beds", "image": f"'{SITE['DOM real estate']}/upload/' || seq || '.jpg'", "n_images": "1",
                "link": f"'{SITE['DOM real estate']}/en/catalog/sale/' || id || '/'",
            },
            wanted="p <> 0",
        ),
        ("Pafilia", "house"): post(
            "Pafilia", PAFILIA, "seq % 9 <> 0 AND seq % 8 <> 0",
            {
                "price": "p", "priceDisplay": ASKING, "beds": "beds", "baths": "baths", "houseSqm": "area + 1",
                "link": "'https://www.pafilia.com/p/' || seq",
            },
            wanted="p <> 0 AND DISTRICT IS NOT NULL",
        ),
        ("Giovani Homes", "house"): post(
            "Giovani Homes", GIOVANI, "seq % 8 <> 0 AND seq % 6 <> 0", {"link": "'https://g.test/' || seq"}
        ),
    }
    for kind in ("house", "plot"):
        for registry, build in (
            ("Bazaraki", bazaraki), ("Kadis Estates", kadis), ("Kazo Real Estate", kazo),
            ("Cyprus Properties", cyprus_properties), ("EstateBud-WP agencies", nch),
        ):
            out[(registry, kind)] = build(kind)
    named = {
        captures.query_name(registry, kind): f"SELECT * EXCLUDE (walk_part, walk_seq) FROM ({text})"
        for (registry, kind), text in out.items()
    }
    plots = {registry: text for (registry, kind), text in out.items() if kind == "plot"}
    named["refresh_plots"] = refreshed("plot", plots) + " SELECT source, decision, count(*) AS n FROM decided GROUP BY source, decision"
    # The source without a taxonomy fails and the others go on.
    sound = {registry: text for (registry, kind), text in out.items() if kind == "house" and registry != "Giovani Homes"}
    columns = 'source, ref, price, district, "houseSqm", "plotSqm", beds, image'
    named["refresh_houses"] = refreshed("house", sound, ENRICHED) + f""" SELECT {columns}, false AS failed
  FROM ready WHERE seq IN (SELECT seq FROM decided WHERE decision = 'kept')
UNION ALL SELECT 'Giovani Homes', {", ".join(["NULL"] * 7)}, true"""
    named["stream_runs"] = refreshed("plot", plots) + """ SELECT * EXCLUDE (walk_source, walk_part, walk_seq, seq)
  FROM ready WHERE seq IN (SELECT seq FROM decided WHERE decision = 'kept')"""
    named["partial_walk"] = f"""SELECT * EXCLUDE (walk_part, walk_seq) FROM ({out[("Bazaraki", "plot")]})
  WHERE walk_seq <= (SELECT floor(max(o_orderkey) / 20) * 10 + 5 FROM orders)"""
    named["source_predicate"] = f"SELECT * FROM ({named[captures.query_name('Bazaraki', 'house')]}) WHERE price >= 100000 AND beds > 2"
    # One source with unique links: publishing keeps every extracted listing.
    named["stream_refresh"] = named[captures.query_name("Bazaraki", "plot")]
    named["snapshot_publish"] = houses("SELECT * FROM houses")
    return named
