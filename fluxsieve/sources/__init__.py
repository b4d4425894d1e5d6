"""XML data sets and binary codecs."""
