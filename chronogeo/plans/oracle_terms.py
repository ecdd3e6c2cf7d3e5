"""The word patterns that the oracle checks by, spelled out: they are not read from the code under test."""

# fmt: off
INCIDENT = "|".join((
    'arson', 'assassination', 'attack', 'avalanche', 'bankruptcy', 'battle', 'blast', 'bombing', 'boycott', 'catastrophe', 'closure', 'collapse',
    'controversy', 'crash', 'cyclone', 'demonstration', 'derailment', 'disaster', 'dissolution', 'earthquake', 'epidemic', 'eruption', 'explosion',
    'famine', 'fire', 'flood', 'hurricane', 'invasion', 'killing', 'landslide', 'lawsuit', 'lockout', 'massacre', 'murder', 'outbreak', 'pandemic',
    'protest', 'raid', 'revolt', 'riot', 'scandal', 'shooting', 'siege', 'sinking', 'strike', 'tornado', 'tragedy', 'trial', 'uprising', 'walkout',
    'war', 'wreck',
))
INSTITUTION = "|".join((
    'abbey', 'academy', 'airline', 'aquarium', 'arboretum', 'archive', 'arena', 'art gallery', 'asylum', 'bank', 'baseball team', 'basilica',
    'basketball team', 'botanical garden', 'brand', 'brewery', 'broadcaster', 'bus company', 'casino', 'cathedral', 'chain', 'chapel', 'church',
    'cinema', 'clinic', 'college', 'company', 'concert hall', 'conglomerate', 'conservatory', 'convent', 'corporation', 'cricket club',
    'department store', 'diocese', 'distillery', 'factory', 'film studio', 'firm', 'football club', 'foundry', 'gymnasium', 'hospital', 'hotel',
    'ice hockey team', 'infirmary', 'inn', 'insurer', 'library', 'magazine', 'manufacturer', 'medical cent(?:er|re)', 'mill', 'monastery', 'mosque',
    'museum', 'newspaper', 'observatory', 'opera house', 'parish', 'periodical', 'planetarium', 'polytechnic', 'priory', 'publisher',
    'publishing house', 'racecourse', 'radio (?:channel|network|station)', 'railway company', 'record label', 'refinery', 'restaurant', 'retailer',
    'rugby club', 'sanatorium', 'school', 'schools', 'seminary', 'shipping line', 'shipyard', 'shopping (?:center|centre|mall)', 'sports club',
    'sports team', 'stadium', 'synagogue', 'tabloid', 'television (?:channel|network|station)', 'temple', 'theater', 'theatre', 'university',
    'winery', 'zoo',
))
SETTLEMENT = "|".join((
    'borough', 'capital (?:city )?of', 'census-designated place', 'cities', 'city', 'commune', 'hamlet', 'locality', 'metropolis', 'municipality',
    'neighborhood', 'neighbourhood', 'settlement', 'suburb', 'town', 'township', 'unincorporated (?:area|community)', 'urban (?:area|district)',
    'village',
))
SOVEREIGN = "|".join((
    'independent (?:country|nation|state)', 'sovereign state',
))
SUBNATIONAL = "|".join((
    'administrative (?:division|region|territorial entity|unit)', 'autonomous (?:community|region|republic)', 'canton', 'county',
    'department (?:in|of)', 'district', 'federal state', 'governorate', 'krai', 'oblast', 'okrug', 'parish', 'prefecture', 'province',
    'region (?:in|of)', 'republic (?:in|of) (?:russia|the russian federation|the soviet union|the ussr)', 'state (?:in|of)', 'territory (?:in|of)',
    'voivodeship',
))
COUNTRY = "|".join((
    'caliphate', 'confederation', 'country', 'empire', 'kingdom (?:in|of)', 'nation', 'republic (?:in|of)',
))
PHRASED = "|".join((
    'admission', 'admitted', 'charter', 'chartered', 'created', 'creation', 'discover', 'discovered', 'discovery', 'establish', 'established',
    'establishment', 'found', 'foundation', 'founded', 'founding', 'incorporated', 'incorporation', 'statehood',
))
KIND_WORDS = {'conflict': 'battle|invasion|siege|war',
 'founding': 'declares|established|founded|gains|independence|secedes',
 'treaty': 'accord|convention|pact|treaty'}
