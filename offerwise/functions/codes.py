"""Label codes of the data dictionary."""

# The position of a label is its code; the spelling follows the data.
CATEGORIES = (
    "Grocery",
    "Bakery",
    "Skin & Hair Care",
    "Pharmaceutical",
    "Seafood",
    "Packaged Meat",
    "Dairy, Juices & Snacks",
    "Natural Products",
    "Miscellaneous",
    "Prepared Food",
    "Meat",
    "Vegetables (cut)",
    "Travel",
    "Garden",
    "Flowers & Plants",
    "Salads",
    "Restauarant",
)
BRAND_TYPES = ("Established", "Local")
CAMPAIGN_TYPES = ("X", "Y")
