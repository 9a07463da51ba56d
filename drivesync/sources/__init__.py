"""Listings, directory trees and change logs as DataFrames."""
