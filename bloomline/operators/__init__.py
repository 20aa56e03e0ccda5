"""DataFrame operators: reshape, staging, marts, features, models, checks, serving."""
