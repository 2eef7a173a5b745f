"""Reports, warehouse, marts, quality gates, classifier and the jobs that run them."""
