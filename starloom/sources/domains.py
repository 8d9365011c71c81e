"""Value domains of the retail mart.

FIXED VALUES. The lists below are stated as plain text because the
analytical queries filter on these exact strings; a mart that lacks
them would return empty answers.  Every literal the queries test for
is contained; the remaining entries only widen the domain.
"""

# fixed values: item categories
CATEGORIES = [
    "Books", "Children", "Electronics", "Home", "Jewelry",
    "Men", "Music", "Shoes", "Sports", "Women",
]

# fixed values: item classes
CLASSES = [
    "personal", "portable", "reference", "self-help", "accessories",
    "classical", "fragrances", "pants", "consignment", "wallpaper",
    "parenting", "musical", "womens", "birdal", "shirts",
    "dresses", "football", "computers", "stereo", "pop",
]

# fixed values: item brands
BRANDS = [
    "scholaramalgamalg #14", "scholaramalgamalg #7", "exportiunivamalg #9",
    "scholaramalgamalg #9", "amalgimporto #1", "edu packscholar #1",
    "exportiimporto #1", "importoamalg #1", "corpunivamalg #3",
    "brandbrand #4", "namelessmaxi #6", "univunivamalg #2",
    "maxicorp #8", "amalgamalg #5", "edu packimporto #2", "importobrand #7",
]

# fixed values: item colours
COLORS = [
    "orchid", "chiffon", "papaya", "burlywood", "navy", "bisque",
    "azure", "chocolate", "cornflower", "salmon", "midnight", "snow",
    "steel", "purple", "gainsboro", "metallic", "forest", "lace",
    "maroon", "burnished", "dim", "navajo", "khaki", "powder",
    "slate", "tan", "lime", "olive", "peach", "sienna",
]

# fixed values: item units
UNITS = [
    "Pound", "Lb", "Bundle", "Each", "N/A", "Tsp", "Bunch", "Gross",
    "Oz", "Box", "Carton", "Tbl", "Dram", "Unknown", "Gram", "Ounce",
    "Cup", "Dozen", "Pallet", "Case", "Ton",
]

# fixed values: item sizes
SIZES = ["petite", "medium", "N/A", "extra large", "small", "large", "economy"]

# fixed values: US states of addresses
STATES = [
    "CO", "IL", "MN", "OH", "MT", "NM", "TX", "MO", "MI", "CA", "WA", "GA",
    "ND", "WI", "AL", "NC", "OK", "MS", "TN", "KY", "OR", "IN", "WV",
    "VA", "SD", "NE", "KS", "IA",
]

# fixed values: counties
COUNTIES = [
    "Walker County", "Richland County", "Gaines County", "Douglas County",
    "Dona Ana County", "Williamson County", "Ziebach County",
    "Franklin Parish", "Barrow County", "Luce County", "Bronx County",
    "Jackson County",
]

# fixed values: cities
CITIES = [
    "Hopewell", "Midway", "Fairview", "Oak Grove", "Five Points",
    "Pleasant Hill", "Centerville", "Riverside", "Greenwood", "Salem",
    "Lakeview", "Glendale",
]

# fixed values: five-digit zip codes
ZIPS = [
    "85669", "86197", "88274", "83405", "86475", "85392", "85460",
    "80348", "81792", "89436", "30868", "65085", "22977", "83927",
    "77557", "58429", "40697",
]

# fixed values: store names
STORE_NAMES = ["ought", "able", "pri", "ese", "anti", "cally", "ation", "eing", "bar", "n st"]

# fixed values: company names (stores and web sites)
COMPANY_NAMES = ["pri", "able", "ought", "ese", "anti", "cally"]

# fixed values: household buying potential
BUY_POTENTIAL = [">10000", "5001-10000", "1001-5000", "501-1000", "0-500", "Unknown"]

# fixed values: demographics
GENDERS = ["M", "F"]
MARITAL = ["M", "S", "D", "W", "U"]
EDUCATION = [
    "Primary", "Secondary", "College", "2 yr Degree", "4 yr Degree",
    "Advanced Degree", "Unknown",
]
CREDIT = ["Good", "High Risk", "Low Risk", "Unknown"]

# fixed values: weekday names, Sunday first (d_dow 0 = Sunday)
DAY_NAMES = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]

# fixed values: ship modes
SHIP_TYPES = ["EXPRESS", "NEXT DAY", "OVERNIGHT", "TWO DAY", "REGULAR", "LIBRARY"]
CARRIERS = [
    "DIAMOND", "AIRBORNE", "UPS", "FEDEX", "DHL", "USPS", "TBS", "ZHOU",
    "ZOUROS", "MSC", "LATVIAN", "ALLIANCE", "ORIENTAL", "BARIAN",
    "BOXBUNDLES", "GREAT EASTERN", "GERMA", "HARMSTORF", "PRIVATECARRIER", "RUPEKSA",
]

# fixed values: return reasons
REASONS = [
    "Did not like the warranty", "Package was damaged", "Stopped working",
    "Did not get it on time", "Not the product that was ordered",
    "Parts missing", "Does not work with a product that I have",
    "Gift exchange", "Did not like the color", "Did not like the model",
    "Did not like the make", "Did not fit", "Wrong size", "Lost my job",
    "Found a better price in a store",
]

# fixed values: call centers
CALL_CENTER_NAMES = [
    "NY Metro", "Mid Atlantic", "North Midwest", "Pacific Northwest",
    "California", "Hawaii/Alaska",
]

# fixed values: people
SALUTATIONS = ["Mr.", "Mrs.", "Ms.", "Dr.", "Sir", "Miss"]
FIRST_NAMES = [
    "James", "Mary", "John", "Linda", "Robert", "Susan", "Michael", "Karen",
    "David", "Nancy", "William", "Lisa", "Richard", "Betty", "Joseph",
    "Sandra", "Thomas", "Ashley", "Charles", "Donna", "Daniel", "Carol",
    "Matthew", "Ruth",
]
LAST_NAMES = [
    "Smith", "Johnson", "Williams", "Brown", "Jones", "Garcia", "Miller",
    "Davis", "Rodriguez", "Martinez", "Hernandez", "Lopez", "Gonzalez",
    "Wilson", "Anderson", "Thomas", "Taylor", "Moore", "Jackson", "Martin",
    "Lee", "Perez", "Thompson", "White", "Harris", "Sanchez", "Clark",
    "Ramirez", "Lewis", "Robinson", "Walker", "Young",
]
COUNTRIES = [
    "UNITED STATES", "CANADA", "MEXICO", "GERMANY", "FRANCE", "JAPAN",
    "BRAZIL", "INDIA", "KENYA", "SPAIN", "NORWAY", "PERU",
]
STREET_NAMES = [
    "Main", "Oak", "Park", "Maple", "Cedar", "Elm", "Lake", "Hill",
    "Pine", "Washington", "Lincoln", "Jefferson",
]
STREET_TYPES = ["Street", "Avenue", "Blvd", "Court", "Drive", "Lane", "Road", "Way"]
LOCATION_TYPES = ["apartment", "condo", "single family"]
WAREHOUSE_NAMES = [
    "Conventional childr", "Important issues liv", "Doors canno",
    "Bad cards must make.", "Operations should",
]
MEAL_TIMES = {"breakfast": (6, 8), "lunch": (11, 13), "dinner": (17, 19)}
