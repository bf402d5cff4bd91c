"""Search terms by role, keywords by city and place types by role."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Terms of the fourteen roles.
ROLE_TERMS = {
    "Students": ["student organization", "student initiative", "student association", "student group"],
    "Researchers": ["research group", "researcher", "research team", "research laboratory"],
    "Higher Education Institutions": ["university", "college", "higher education", "institute of technology"],
    "Research Institutes": ["research institute", "research center", "research facility", "scientific institute"],
    "Non-Governmental Organizations": ["NGO", "non-profit", "foundation", "association", "non-governmental organization"],
    "Industry Partners": ["company", "manufacturer", "consultancy", "service provider", "enterprise"],
    "Startups and Entrepreneurs": ["startup", "entrepreneur", "incubator", "accelerator", "new venture"],
    "Public Authorities": ["government office", "municipal service", "public authority", "city administration"],
    "Policy Makers": ["policy institute", "think tank", "policy organization"],
    "End-Users": ["consumer group", "user community", "customer organization"],
    "Citizen Associations": ["community group", "neighborhood association", "citizen initiative", "local association"],
    "Media and Communication Partners": ["news outlet", "media company", "press agency", "publisher", "communication agency"],
    "Funding Bodies": ["grant organization", "investment fund", "venture capital", "funding agency"],
    "Knowledge and Innovation Communities": ["innovation hub", "innovation center", "business network", "cluster organization", "innovation community"],
}
# Further terms of the roles in the second region's language.
LOCAL_TERMS = {
    "Students": ["studentska organizacija", "studentski centar", "studentski dom", "omladinska organizacija", "omladinski centar"],
    "Researchers": ["istraživač", "istraživački tim", "laboratorija", "naučni rad"],
    "Higher Education Institutions": ["univerzitet", "fakultet", "visoka škola", "akademija", "institut", "obrazovanje", "visoko obrazovanje"],
    "Research Institutes": ["istraživački institut", "istraživački centar", "naučni institut", "zavod", "centar za istraživanje"],
    "Non-Governmental Organizations": ["udruženje", "fondacija", "organizacija", "nevladina organizacija", "civilno društvo", "humanitarna organizacija", "dobrotvorna organizacija"],
    "Industry Partners": ["fabrika", "proizvodnja", "preduzeće", "firma", "kompanija", "industrija", "d.o.o.", "a.d.", "proizvođač"],
    "Startups and Entrepreneurs": ["inkubator", "akcelerator", "biznis centar", "poslovni centar", "coworking", "tech hub", "IT kompanija", "preduzetnik"],
    "Public Authorities": ["gradska uprava", "opština", "javna ustanova", "ministarstvo", "sekretarijat", "pokrajinska vlada", "lokalna samouprava"],
    "Policy Makers": ["institut za javne politike", "centar za politike", "analitički centar"],
    "End-Users": ["udruženje potrošača", "zajednica korisnika", "potrošački centar"],
    "Citizen Associations": ["mesna zajednica", "građanska inicijativa", "lokalno udruženje", "kulturni centar", "dom kulture", "društvo"],
    "Media and Communication Partners": ["medijska kuća", "novinska agencija", "izdavač", "radio", "televizija", "marketing agencija", "PR agencija"],
    "Funding Bodies": ["investicioni fond", "razvojni fond", "banka", "finansijska institucija", "fond za razvoj"],
    "Knowledge and Innovation Communities": ["inovacioni centar", "naučno-tehnološki park", "klaster", "poslovna mreža", "razvojni centar", "centar za inovacije"],
}
# Keywords of two cities, all and the few for a small budget.
KEYWORDS = {
    "novi_sad": [
        "cirkularna ekonomija", "reciklaža", "održivost", "reciklažni centar", "upravljanje otpadom", "popravka", "održiva proizvodnja",
        "циркуларна економија", "рециклажа", "одржи вост", "circular economy", "recycling", "sustainability", "zero waste",
    ],
    "cahul": [
        "economie circulară", "reciclare", "sustenabilitate", "colectare deșeuri", "gestionare deșeuri", "reparare", "producție durabilă",
        "циркулярная экономика", "переработка", "устойчивость", "circular economy", "recycling", "sustainability", "zero waste",
    ],
}
FEW_KEYWORDS = {
    "novi_sad": ["reciklaža", "održivost", "circular economy", "recycling", "zero waste"],
    "cahul": ["reciclare", "sustenabilitate", "circular economy", "recycling", "zero waste"],
}
# Place types of the roles that have some.
PLACE_TYPES = {
    "Higher Education Institutions": ["university", "school", "secondary_school", "primary_school"],
    "Public Authorities": ["local_government_office", "city_hall", "courthouse"],
    "Industry Partners": ["store", "shopping_mall", "electronics_store", "hardware_store"],
    "Funding Bodies": ["bank", "finance", "accounting"],
    "Media and Communication Partners": ["book_store"],
    "Knowledge and Innovation Communities": ["library"],
}


def terms(spark: SparkSession, local: bool = True) -> DataFrame:
    rows = [(role, t) for role, own in ROLE_TERMS.items() for t in [*own, *(LOCAL_TERMS[role] if local else [])]]
    return spark.createDataFrame(rows, "role string, term string")


def keywords(spark: SparkSession, city: str, few: bool = False) -> DataFrame:
    return spark.createDataFrame([(k,) for k in (FEW_KEYWORDS if few else KEYWORDS)[city]], "keyword string")


def types(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(role, t) for role, own in PLACE_TYPES.items() for t in own], "role string, type string")
