"""keyrelay.sources"""
