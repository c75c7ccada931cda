"""Training-data operators over whole document, page and vector tables. Nothing outside this folder imports it."""
