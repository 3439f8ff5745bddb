"""Fixed word lists: facts about the two languages that the rules look for."""

SWAHILI = tuple(
    "bado bila haya hivyo huku jana kama kesho kitu kutu kwa leo mimi mwingine na ndani ndio ni nje pale pia "
    "sababu sana sasa shukrani sisi vitu wakati wao wapi wewe ya yake yetu yeye".split()
)
SHENG = tuple(
    "aje brathe bro buda dem form gari jobo kejani mafta manze manzee mbogi mresh msee mtaa nashida ndo nduthi "
    "ng'ara niko nikoarea sheng sherehe wacha wasee".split()
)
#: Lists of the token-ratio rule.
RATIO_SWAHILI = tuple(sorted((set(SWAHILI) - {"kutu", "vitu"}) | set("asante hakuna jambo kazi mtoto mungu nimefanya nimeona nyumba rafiki salamu shule".split())))
RATIO_SHENG = tuple(
    "bazuu brathe bro buda chuo dem form jobo kejani kude kudea mabeste madem manze manzee mbogi mresh msee mtaa "
    "naje nduthi ngara nikoaje nikoarea ploti supu ule umsee wasee".split()
)
LABELS = ("Swahili", "English and Swahili", "Sheng", "English")
