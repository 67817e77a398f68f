"""External models behind one interface; their responses are tables, so every decision after them can be repeated."""
