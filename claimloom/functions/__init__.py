"""Column expressions: ages, bands, ratios, labels, coercions. All run inside codegen."""
