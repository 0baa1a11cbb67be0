"""Fixed values.

Names, orders, aliases and identifiers that decide results. They are data, not
logic: every list is in its effective order, because the first hit wins.
"""

# Publisher priority for houses, best first. A source not listed ranks last.
HOUSE_PRIORITY = (
    "Bazaraki", "Zyprus", "Altamira Real Estate", "Altamira", "eAuction Cyprus",
    "eAuction", "BidX1", "Kadis Estates", "Pafilia", "Giovani Homes",
    "Kazo Real Estate", "Cyprus Properties", "NCH Real Estate", "DOM real estate",
    "home.cy", "FOX Realty", "BuySellCyprus", "Realting", "A Place in the Sun",
)

# Publisher priority for plots, best first.
PLOT_PRIORITY = (
    "Bazaraki", "eAuction Cyprus", "Kadis Estates", "Kazo Real Estate",
    "Cyprus Properties", "NCH Real Estate", "Realting", "A Place in the Sun",
)

# Capture order of the registered sources (registry name, kind).
HOUSE_REGISTRY = (
    "Altamira", "Bazaraki", "eAuction", "Zyprus", "BidX1", "BuySellCyprus",
    "home.cy", "FOX Realty", "Realting", "A Place in the Sun", "Kadis Estates",
    "Kazo Real Estate", "Cyprus Properties", "EstateBud-WP agencies",
    "DOM real estate", "Pafilia", "Giovani Homes",
)
PLOT_REGISTRY = (
    "Bazaraki", "Kadis Estates", "Kazo Real Estate", "Cyprus Properties",
    "EstateBud-WP agencies",
)

# Area tolerances of the two match rules, relative to the larger area.
HOUSE_AREA_TOLERANCE = 0.05
PLOT_AREA_TOLERANCE = 0.03

DISTRICTS = ("Nicosia", "Limassol", "Larnaca", "Paphos", "Famagusta")

# Final spelling of a district, applied to every listing before deduplication.
DISTRICT_CANON = {
    "Pafos": "Paphos", "Lefkosia": "Nicosia", "Ammochostos": "Famagusta",
    "Germasogeia": "Limassol", "Lemesos": "Limassol",
}

# Transliterated district names found inside a location text.
DISTRICT_TRANSLITERATED = {
    "Lefkosia": "Nicosia", "Lemesos": "Limassol", "Larnaka": "Larnaca",
    "Pafos": "Paphos", "Ammochostos": "Famagusta",
}

# Upper-case district words of the auction site.
AUCTION_DISTRICTS = {
    "LIMASSOL": "Limassol", "NICOSIA": "Nicosia", "PAFOS": "Paphos",
    "FAMAGUSTA": "Famagusta", "LARNACA": "Larnaca",
}

# Communities of the Realting cards.
REALTING_AREAS = {
    "Lefkosia": "Nicosia", "Pafos": "Paphos", "Ammochostos": "Famagusta",
    "Peyia": "Paphos", "Pegeia": "Paphos", "Yeroskipou": "Paphos", "Geroskipou": "Paphos",
    "Kouklia": "Paphos", "Tala": "Paphos", "Polis": "Paphos", "Kissonerga": "Paphos",
    "Chloraka": "Paphos", "Argaka": "Paphos", "Konia": "Paphos", "Kamares": "Paphos",
    "Mesogi": "Paphos", "Emba": "Paphos", "Tremithousa": "Paphos", "Pomos": "Paphos",
    "Paralimni": "Famagusta", "Ayia Napa": "Famagusta", "Agia Napa": "Famagusta",
    "Sotira": "Famagusta", "Frenaros": "Famagusta", "Protaras": "Famagusta",
    "Avgorou": "Famagusta", "Deryneia": "Famagusta", "Liopetri": "Famagusta",
    "Agios Tychonas": "Limassol", "Agiou Tychona": "Limassol", "Germasogeia": "Limassol",
    "Erimi": "Limassol", "Agiou Athanasiou": "Limassol", "Parekklisia": "Limassol",
    "Ypsonas": "Limassol", "Palodeia": "Limassol", "Pyrgou Lemesou": "Limassol",
    "Pyrgos": "Limassol", "Souni": "Limassol", "Mouttagiaka": "Limassol",
    "Pissouri": "Limassol", "Kolossi": "Limassol", "Dromolaxia": "Larnaca",
    "Oroklini": "Larnaca", "Kiti": "Larnaca", "Pervolia": "Larnaca", "Pyla": "Larnaca",
    "Livadia": "Larnaca", "Aradippou": "Larnaca", "Mazotos": "Larnaca",
    "Tersefanou": "Larnaca", "Latsia": "Nicosia", "Lakatameia": "Nicosia",
    "Strovolos": "Nicosia", "Egkomi": "Nicosia", "Aglantzia": "Nicosia",
    "Geri": "Nicosia", "Tseri": "Nicosia",
}

# First-segment prefixes of Kadis and WordPress agency houses.
KADIS_AREAS = {
    "Lakatameia": "Nicosia", "Lakatamia": "Nicosia", "Strovolos": "Nicosia",
    "Latsia": "Nicosia", "Aglantzia": "Nicosia", "Engomi": "Nicosia", "Dali": "Nicosia",
    "Tseri": "Nicosia", "Germasogeia": "Limassol", "Mesa": "Limassol",
    "Paralimni": "Famagusta", "Deryneia": "Famagusta",
}

# First-segment prefixes of Kadis plots.
KADIS_PLOT_AREAS = {
    "Lakatameia": "Nicosia", "Lakatamia": "Nicosia", "Strovolos": "Nicosia",
    "Latsia": "Nicosia", "Aglantzia": "Nicosia", "Engomi": "Nicosia", "Egkomi": "Nicosia",
    "Dali": "Nicosia", "Tseri": "Nicosia", "Germasogeia": "Limassol", "Pyrgos": "Limassol",
    "Paralimni": "Famagusta", "Deryneia": "Famagusta",
}

# Word prefixes of the Kazo cards.
KAZO_AREAS = {
    "Germasoyeia": "Limassol", "Germasogeia": "Limassol", "Neapolis": "Limassol",
    "Mesa": "Limassol", "Strovolos": "Nicosia", "Lakatameia": "Nicosia",
    "Latsia": "Nicosia", "Aglantzia": "Nicosia", "Engomi": "Nicosia",
    "Paralimni": "Famagusta", "Deryneia": "Famagusta",
}

# Word prefixes of the Cyprus Properties cards.
CYPRUS_PROPERTIES_AREAS = {
    "Germasoyeia": "Limassol", "Germasogeia": "Limassol", "Neapolis": "Limassol",
    "Kouklia": "Paphos", "Strovolos": "Nicosia", "Lakatameia": "Nicosia",
    "Latsia": "Nicosia", "Aglantzia": "Nicosia", "Engomi": "Nicosia",
    "Paralimni": "Famagusta", "Deryneia": "Famagusta", "Livadia": "Larnaca",
    "Oroklini": "Larnaca", "Pedoulas": "Nicosia",
}

# City term names to districts.
PAFILIA_CITIES = {
    "Limassol": "Limassol", "Paphos": "Paphos", "Pafos": "Paphos",
    "Larnaca": "Larnaca", "Nicosia": "Nicosia", "Ammochostos": "Famagusta",
}
GIOVANI_CITIES = {
    "Paralimni": "Famagusta", "Protaras": "Famagusta", "Pernera": "Famagusta",
    "Ayia Napa": "Famagusta", "Kapparis": "Famagusta", "Cape Greco": "Famagusta",
    "Famagusta": "Famagusta", "Larnaca": "Larnaca", "Aradippou": "Larnaca",
    "Nicosia": "Nicosia",
}

# Capture partitions in the order they are walked.
BAZARAKI_PARTITIONS = ("Limassol", "Nicosia", "Larnaca", "Paphos", "Famagusta")
FOX_PARTITIONS = ("nicosia", "limassol", "larnaca", "paphos", "famagusta")
CYPRUS_PROPERTIES_PARTITIONS = {"house": ("house", "apartment"), "plot": ("land",)}
# Auction states open for bidding, by site state id.
BIDDABLE_STATUSES = {
    "3": "Posted",
    "5": "Finalized List of Eligible Bidders",
    "6": "Ready to be Conducted",
    "7": "Open",
}

# Term ids of the two WordPress REST sources.
PAFILIA_STATUS_FOR_RENT = 29
GIOVANI_ACTION_SALES = 64
GIOVANI_CATEGORY_SHOP = 172

PLOT_TYPES = ("residential", "commercial", "agricultural", "industrial", "tourist")

# Greek property words of the auction notice, in match order, with their English label.
NOTICE_PROPERTY_TYPES = {
    "ΚΑΤΟΙΚΙΑ": "Residence", "ΔΙΑΜΕΡΙΣΜΑ": "Apartment", "ΟΙΚΟΠΕΔΟ": "Building plot",
    "ΧΩΡΑΦΙ": "Field", "ΟΙΚΙΑ": "House", "ΒΙΛΑ": "Villa", "ΚΑΤΑΣΤΗΜΑ": "Shop",
    "ΓΡΑΦΕΙΟ": "Office", "ΑΠΟΘΗΚΗ": "Warehouse", "ΤΕΜΑΧΙΟ": "Parcel", "ΓΗ": "Land",
    "ΜΕΖΟΝΕΤΑ": "Maisonette",
}
# Column headings of the notice table.
NOTICE_HEADINGS = {
    "registration": ("Εγγραφή",),
    "area": ("Έκταση",),
    "share": ("συμφέρον", "Εγγεγραμμένο"),
    "type": ("Είδος",),
}
# Geometry of the notice table: row band, marker margin and column tolerances.
NOTICE_ROW_BAND = 22
NOTICE_MARKER_X = 36
NOTICE_TOLERANCE = {"registration": 45, "area": 40, "share": 40, "type": 55}
NOTICE_MAX_AREA = 2000000

# A picture counts as a photograph from these values on.
PHOTO_MIN_SATURATION = 12
PHOTO_MAX_WHITE = 0.5
PHOTO_MIN_SIDE = 200
PHOTO_SAMPLES = 20000
NEAR_WHITE_MAX = 235
NEAR_WHITE_SPREAD = 15

# Short publisher labels that are not simply the first word.
SHORT_NAMES = {
    "house": {"A Place in the Sun": "APITS"},
    "plot": {"A Place in the Sun": "APITS", "eAuction Cyprus": "eAuction", "Kadis Estates": "Kadis"},
}

# Site roots used to complete links.
SITES = {
    "Altamira Real Estate": "https://www.altamirarealestate.com.cy",
    "Bazaraki": "https://www.bazaraki.com",
    "eAuction Cyprus": "https://www.eauction-cy.com",
    "BidX1": "https://bidx1.com",
    "Realting": "https://realting.com",
    "A Place in the Sun": "https://www.aplaceinthesun.com",
    "Cyprus Properties": "https://www.cyprusproperties.com.cy",
    "DOM real estate": "https://dom.com.cy",
}
EAUCTION_LIST_PATH = "/en/Home/HlektronikoiPleistiriasmoi?type=5"
NCH_HOST = "nchrealestate.com"

# Freshness: hours after which the snapshot counts as stale.
STALE_AFTER_HOURS = 30
