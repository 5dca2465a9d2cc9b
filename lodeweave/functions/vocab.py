"""Namespaces, value lists and thresholds that results depend on."""

BASE = "https://w3id.org/lodeweave/graph/"
# fixed values
NAMESPACES = {
    "schema": "https://schema.org/",
    "fair4ml": "https://w3id.org/fair4ml/",
    "codemeta": "https://w3id.org/codemeta/",
    "cr": "http://mlcommons.org/croissant/",
    "rdf": "http://www.w3.org/1999/02/22-rdf-syntax-ns#",
    "rdfs": "http://www.w3.org/2000/01/rdf-schema#",
    "xsd": "http://www.w3.org/2001/XMLSchema#",
}
# fixed values: prefixes in use and their namespaces
PREFIXES = {"schema.org": "schema", "fair4ml": "fair4ml", "codemeta": "codemeta"}
RDF_TYPE = NAMESPACES["rdf"] + "type"
# fixed values: phrases of an untouched card template, and how many make a card a template
TEMPLATE_PHRASES = (
    "<!-- Provide a quick summary of what the model is/does. -->",
    "This is the model card of a 🤗 transformers model that has been pushed on the Hub. This model card has been automatically generated.",
    "[More Information Needed]",
    "<!-- Address questions around how the model is intended to be used, including the foreseeable users of the model and those affected by the model. -->",
    "<!-- This relates heavily to the Technical Specifications. Content here should link to that section when it is relevant to the training procedure. -->",
    "<!-- This section is meant to convey recommendations with respect to the bias, risk, and technical limitations. -->",
    "<!-- Provide the basic links for the model. -->",
    "## Model Card Contact",
)
MISSING_PHRASE = "[More Information Needed]"
MIN_CARD_CHARS, TEMPLATE_GAPS, TEMPLATE_HITS = 200, 38, 7
NOT_FOUND = "Information not found"
# fixed values: predicates whose objects are shown by name
NAMED_PREDICATES = tuple(NAMESPACES["schema"] + x for x in ("keywords",)) + tuple(NAMESPACES["fair4ml"] + x for x in ("sharedBy", "mlTask", "fineTunedFrom", "trainedOn", "testedOn"))
# fixed values: node types that a dataset description drops
DROPPED_TYPES = tuple(NAMESPACES["cr"] + x for x in ("FileSet", "File", "FileObject", "FileObjectSet"))
DROPPED_TYPES_LEGACY = DROPPED_TYPES + tuple(NAMESPACES["cr"] + x for x in ("RecordSet", "Field"))
# fixed values: property groups of frames that hold one column per property
ENTITY_PROPERTIES = ("fair4ml:mlTask", "fair4ml:sharedBy", "fair4ml:testedOn", "fair4ml:evaluatedOn", "fair4ml:trainedOn", "codemeta:referencePublication")
DATE_PROPERTIES = ("schema.org:datePublished", "schema.org:dateCreated", "schema.org:dateModified")
TEXT_PROPERTIES = (
    "schema.org:storageRequirements",
    "schema.org:name",
    "schema.org:author",
    "schema.org:discussionUrl",
    "schema.org:identifier",
    "schema.org:url",
    "schema.org:releaseNotes",
    "schema.org:license",
    "codemeta:readme",
    "codemeta:issueTracker",
    "fair4ml:intendedUse",
)
# fixed values: search index by platform
PLATFORM_INDEX = {"huggingface": "hf_models", "open_ml": "openml_models", "ai4life": "ai4life_models"}
